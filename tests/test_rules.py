"""Every ladder at its edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.functions import attendance as att, payroll as pay, tiers, times

HOUR, DAY = 3_600_000, 86_400_000
MIDNIGHT = 20_000 * DAY


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def test_presence_status_and_hours(spark):
    rows = [(None, None, "ON_TIME"), (None, HOUR, "ON_TIME"), (HOUR, None, "ON_TIME"), (0, HOUR, None), (0, 9 * HOUR, "LATE")]
    start, end = F.col("i"), F.col("o")
    got = values(
        spark,
        "i bigint, o bigint, s string",
        rows,
        att.presence_status(start, end, F.col("s")),
        att.worked_hours(start, end),
        att.overtime_hours(att.worked_hours(start, end)),
    )
    assert got == [
        ("MISSING_DATA", None, 0.0),
        ("NOT_CHECKED_IN", None, 0.0),
        ("NOT_CHECKED_OUT", None, 0.0),
        (None, 1.0, 0.0),
        ("LATE", 9.0, 1.0),
    ]


def test_overtime_edges(spark):
    got = values(spark, "h double", [(8.0,), (8.5,), (None,), (-3.0,)], att.overtime_hours(F.col("h")))
    assert got == [(0.0,), (0.5,), (0.0,), (0.0,)]


@pytest.mark.parametrize("offset", [0, att.ZONE_OFFSET_MS])
def test_late_and_shift_edges(spark, offset):
    clocks = [32_399_999, 32_400_000, 32_400_001, 43_199_999, 43_200_000, 64_799_999, 64_800_000]
    rows = [(MIDNIGHT + c - offset,) for c in clocks] + [(None,)]
    got = values(spark, "t bigint", rows, att.is_late(F.col("t"), offset), att.shift_label(F.col("t"), offset))
    assert [g[0] for g in got] == [False, False, True, True, True, True, True, False]
    assert [g[1] for g in got] == ["MORNING"] * 4 + ["AFTERNOON"] * 2 + ["EVENING", "UNKNOWN"]


def test_progressive_tax_edges(spark):
    edges = [(0.0, 0), (5e6, 250_000), (10e6, 750_000), (18e6, 1_950_000), (32e6, 4_750_000), (40e6, 6_750_000)]
    rows = [(11e6 + taxable,) for taxable, _ in edges] + [(1.0,), (None,)]
    got = values(spark, "net double", rows, pay.progressive_tax(F.col("net")))
    assert [g[0] for g in got] == pytest.approx([float(t) for _, t in edges] + [0.0, None])


def test_flat_tax_and_take_home(spark):
    net = F.col("net")
    got = values(
        spark,
        "net double, base double",
        [(11e6, 1e6), (31e6, 10e6), (None, 1e6)],
        pay.flat_tax(net),
        pay.take_home(net, pay.insurance(F.col("base")), pay.flat_tax(net)),
    )
    assert got == [(0.0, 11e6 - 105_000), (1e6, 31e6 - 1_050_000 - 1e6), (0.0, None)]


def test_tiers(spark):
    totals = [(9_999_999,), (10_000_000,), (49_999_999,), (50_000_000,)]
    assert [r[0] for r in values(spark, "t bigint", totals, tiers.value_tier(F.col("t")))] == [
        "NORMAL",
        "HIGH_VALUE",
        "HIGH_VALUE",
        "VIP",
    ]
    rfm = [(3, 10_000_000), (3, 9_000_000), (2, 5_000_000), (2, 4_999_999), (1, 10_000_000), (1, 1)]
    assert [r[0] for r in values(spark, "n bigint, t bigint", rfm, tiers.rfm_tier(F.col("n"), F.col("t")))] == [
        "Champions",
        "Loyal",
        "Loyal",
        "At Risk",
        "Big Spender",
        "New Customer",
    ]
    late = [(0,), (1,), (2,), (3,), (4,)]
    assert [r[0] for r in values(spark, "n bigint", late, tiers.discipline_tier(F.col("n")))] == [
        "GOOD",
        "GOOD",
        "WARNING",
        "WARNING",
        "CRITICAL",
    ]


def test_round_is_half_away_from_zero(spark):
    got = values(spark, "x double", [(-2.5,), (2.5,)], F.round("x", 0))
    assert got == [(-3.0,), (3.0,)]
    assert values(spark, "x double", [(2.345,)], F.round("x", 2)) == [(2.35,)]


def test_time_units(spark):
    row = [(1_775_037_600_000, 1_775_037_600_000_000, 20_544)]
    got = values(
        spark,
        "ms bigint, us bigint, d int",
        row,
        times.to_time(F.col("ms"), "ms") == times.to_time(F.col("us"), "us"),
        times.to_time(F.col("d"), "days").cast("string"),
        times.days_between(F.col("us"), F.col("us") + F.lit(times.MICROS_PER_DAY)),
    )
    assert got == [(True, "2026-04-01", 1.0)]
    with pytest.raises(ValueError):
        times.to_time(F.col("ms"), "weeks")
