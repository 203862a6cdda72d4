"""Upserts, reloads, appends and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.operators.upsert import append, reload, upsert, upsert_any
from changeloom.sources.tables import scan

LIMITS = "id string, kind string, target string, value bigint, note string"


def rows(frame):
    return {tuple(r) for r in frame.collect()}


@pytest.fixture()
def limits(spark):
    return spark.createDataFrame([("L1", "rate", "portal", 1, "old"), ("L2", "size", None, 2, "old")], LIMITS)


def test_upsert_all_columns(spark, limits):
    new = spark.createDataFrame([("L1", "rate", "portal", 9, "new"), ("L3", "x", "y", 3, "new")], LIMITS)
    assert rows(upsert(limits, new, ["id"])) == {
        ("L1", "rate", "portal", 9, "new"),
        ("L2", "size", None, 2, "old"),
        ("L3", "x", "y", 3, "new"),
    }


def test_upsert_some_columns_on_another_key(spark, limits):
    new = spark.createDataFrame(
        [("N1", "rate", "portal", 9, "new"), ("N2", "size", None, 3, "new"), ("N3", "size", "upload", 4, "new")], LIMITS
    )
    got = upsert(limits, new, ["kind", "target"], ["value"])
    assert rows(got) == {
        ("L1", "rate", "portal", 9, "old"),
        ("L2", "size", None, 2, "old"),
        ("N2", "size", None, 3, "new"),
        ("N3", "size", "upload", 4, "new"),
    }
    assert got.columns == limits.columns


def test_upsert_overwrites_with_null(spark, limits):
    new = spark.createDataFrame([("L1", None, None, None, None)], LIMITS)
    assert ("L1", "rate", "portal", None, "old") in rows(upsert(limits, new, ["id"], ["value"]))


def test_upsert_in_sequence(spark, limits):
    new = spark.createDataFrame(
        [("L9", "a", "first", 1, "first", 1), ("L9", "b", "second", 2, "second", 2), ("L1", "c", "x", 7, "x", 3)],
        LIMITS + ", s int",
    )
    got = rows(upsert(limits, new, ["id"], ["value", "note"], "s"))
    assert ("L9", "a", "first", 2, "second") in got and ("L1", "rate", "portal", 7, "x") in got and len(got) == 3


def test_upsert_again_changes_nothing(spark, limits):
    new = spark.createDataFrame([("L1", "rate", "portal", 9, "new"), ("L3", "x", "y", 3, "new")], LIMITS)
    once = upsert(limits, new, ["id"], ["value"])
    assert rows(upsert(once, new, ["id"], ["value"])) == rows(once)


def test_upsert_on_several_keys(spark, limits):
    keys = [["id"], ["kind", "target"]]
    new = spark.createDataFrame(
        [("N1", "rate", "portal", 9, "new"), ("L2", "moved", "upload", 3, None), ("N3", "size", None, 4, "new")], LIMITS
    )
    assert rows(upsert_any(limits, new, keys)) == {
        ("L1", "rate", "portal", 9, "new"),
        ("L2", "size", None, 3, None),
        ("N3", "size", None, 4, "new"),
    }
    assert rows(upsert_any(limits, new.limit(0), keys)) == rows(limits)
    assert rows(upsert_any(limits.limit(0), new, keys)) == rows(new)


@pytest.mark.parametrize(
    "new, problem",
    [
        ([("L2", "rate", "portal", 1, "x")], "meets several rows"),
        ([("L1", "a", "b", 1, "x"), ("N1", "rate", "portal", 1, "x")], "meet the same row"),
        ([("N1", "a", "b", 1, "x"), ("N2", "a", "b", 1, "x")], "share the key"),
    ],
)
def test_upsert_on_several_keys_refuses_what_is_not_clear(spark, limits, new, problem):
    with pytest.raises(ValueError, match=problem):
        upsert_any(limits, spark.createDataFrame(new, LIMITS), [["id"], ["kind", "target"]])


def test_reload_is_repeatable(spark, folder):
    frame = spark.range(5).select("id")
    reload(spark.range(99).select("id"), folder + "/t")
    for _ in range(2):
        reload(frame, folder + "/t")
        assert rows(scan(spark, folder + "/t", "id bigint")) == rows(frame)


def test_append_numbers_and_fills(spark):
    target = spark.createDataFrame([(5, "a", 0)], "id bigint, name string, version int")
    incoming = spark.range(1000).select(
        (F.lit(999) - F.col("id")).alias("at"), F.when(F.col("id") % 2 == 0, F.lit("n")).alias("name")
    )
    got = append(target, incoming.repartition(7), "id", ["at"], {"name": "none", "version": 1}).orderBy("id").collect()
    assert [r.id for r in got] == [5, *range(6, 1006)]
    assert [r.name for r in got[1:5]] == ["none", "n", "none", "n"] and {r.version for r in got[1:]} == {1}


def test_append_survives_equal_order_values(spark):
    target = spark.createDataFrame([], "id bigint, v bigint")
    incoming = spark.range(500).select(F.lit(1).alias("at"), F.col("id").alias("v"))
    got = append(target, incoming, "id", ["at"]).collect()
    assert sorted(r.id for r in got) == list(range(1, 501)) and {r.v for r in got} == set(range(500))


def test_scan_of_missing_and_marker_only_folders(spark, folder):
    import os

    assert scan(spark, folder + "/missing", "id bigint").count() == 0
    os.makedirs(folder + "/t")
    open(folder + "/t/.keep", "w").close()
    assert scan(spark, folder + "/t", "id bigint, s string").columns == ["id", "s"]
    assert scan(spark, folder + "/t", "id bigint").count() == 0
    spark.range(3).write.mode("append").parquet(folder + "/t")
    assert scan(spark, folder + "/t", "id bigint").count() == 3
