"""Envelopes, unreadable messages and operators over changes."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changeloom.operators.changes import current_rows, latest_per_key, weighted, weighted_count, weighted_sum
from changeloom.registry import Table
from changeloom.sources.changelog import LIFE, RAW_LOG, bad_messages, changes, envelope, file_log, in_generation, message, snapshot_log

T = Table("t", ("id",), "id bigint, v bigint")
WRAPPED = [
    '{"schema":{"type":"struct"},"payload":{"op":"r","ts_ms":1,"before":null,"after":{"id":1,"v":10}}}',
    '{"payload":{"op":"u","ts_ms":2,"before":{"id":1,"v":10},"after":{"id":1,"v":20}}}',
    '{"payload":{"op":"c","ts_ms":3,"before":null,"after":{"id":2,"v":5}}}',
    '{"payload":{"op":"d","ts_ms":4,"before":{"id":2,"v":5},"after":null}}',
    None,
]


def raw(spark, values):
    return spark.createDataFrame([("x.y.t", 0, n, v) for n, v in enumerate(values)], RAW_LOG)


def state(spark, values, on_bad="raise"):
    return {tuple(r) for r in current_rows(changes(raw(spark, values), T, on_bad), T.key, T.row_type).collect()}


def test_state_and_weights(spark):
    assert state(spark, WRAPPED) == {(1, 20)}
    sums = weighted(changes(raw(spark, WRAPPED), T), T.row_type).agg(
        weighted_sum(F.col("v")), weighted_count(), weighted_count(F.col("v"))
    )
    assert tuple(sums.first()) == (20, 1, 1)


def test_bare_and_mixed_forms(spark):
    bare = [v and json.dumps(json.loads(v)["payload"]) for v in WRAPPED]
    assert state(spark, bare) == {(1, 20)}
    assert state(spark, [b if n % 2 else w for n, (b, w) in enumerate(zip(bare, WRAPPED))]) == {(1, 20)}


@pytest.mark.parametrize(
    "bad",
    [
        "garbage",
        "{}",
        '{"payload":null}',
        '{"op":"x","after":{"id":1,"v":1}}',
        '{"op":"u","before":{"id":1,"v":1},"after":null}',
        '{"op":"d","before":null,"after":null}',
        '{"op":"c","after":{"id":"one","v":1}}',
        '{"payload":{"op":"c","after":{"id":3,"v":"many"}}}',
        '{"op":"c","after":{"id":7,"v"',
    ],
)
def test_unreadable_messages(spark, bad):
    values = [*WRAPPED, bad]
    with pytest.raises(Exception, match="unreadable change at x.y.t/0/5"):
        state(spark, values)
    with pytest.raises(Exception, match="unreadable change"):
        changes(raw(spark, values), T).count()
    assert state(spark, values, "skip") == {(1, 20)}
    assert [(r.offset, r.value) for r in bad_messages(raw(spark, values), T).collect()] == [(5, bad)]


def test_on_bad_is_checked(spark):
    with pytest.raises(ValueError):
        changes(raw(spark, WRAPPED), T, "ignore")


def test_unknown_fields_and_null_keys_are_left_out(spark):
    values = ['{"op":"c","extra":1,"after":{"id":1,"v":2,"w":[1]}}', '{"op":"c","after":{"id":null,"v":2}}']
    assert state(spark, values) == {(1, 2)}


def test_order_is_by_offset_not_by_position(spark):
    log = raw(spark, WRAPPED)
    assert {tuple(r) for r in current_rows(changes(log.orderBy(F.desc("offset")), T), T.key, T.row_type).collect()} == {(1, 20)}


def test_key_change_arrives_as_delete_and_create(spark):
    values = [
        '{"op":"c","after":{"id":1,"v":1}}',
        '{"op":"d","before":{"id":1,"v":1}}',
        '{"op":"c","after":{"id":9,"v":1}}',
    ]
    assert state(spark, values) == {(9, 1)}


def test_delete_keeps_key_and_offset(spark):
    latest = latest_per_key(changes(raw(spark, WRAPPED), T), T.key, T.row_type)
    assert {tuple(r) for r in latest.collect()} == {(1, 20, "u", 1), (2, None, "d", 3)}


def test_composite_key(spark):
    t = Table("t", ("a", "b"), "a bigint, b string, v bigint")
    values = ['{"op":"c","after":{"a":1,"b":"x","v":1}}', '{"op":"c","after":{"a":1,"b":"y","v":2}}',
              '{"op":"u","after":{"a":1,"b":"x","v":3}}']
    got = current_rows(changes(raw(spark, values), t), t.key, t.row_type)
    assert {tuple(r) for r in got.collect()} == {(1, "x", 3), (1, "y", 2)}


def test_snapshot_precedes_changes(spark):
    rows = spark.createDataFrame([(1, 1), (3, 3)], T.row_type)
    log = snapshot_log(rows, T, "x.y.t").unionByName(raw(spark, WRAPPED))
    assert {tuple(r) for r in current_rows(changes(log, T), T.key, T.row_type).collect()} == {(1, 20), (3, 3)}


def test_message_round_trip(spark):
    t = Table("t", ("id",), "id bigint, x double, s string, b boolean, `month` string")
    rows = spark.createDataFrame([(1, 0.1 + 0.2, 'a "quoted"\nline', None, "2026-04"), (2, None, "", True, None)], t.row_type)
    for wrapped in (True, False):
        log = snapshot_log(rows, t, "t", wrapped)
        got = current_rows(changes(log, t), t.key, t.row_type)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in rows.collect()}


def test_file_log_reads_json_lines(spark, folder):
    raw(spark, WRAPPED).write.json(folder + "/log", ignoreNullFields=False)
    log = file_log(spark, folder + "/log", streaming=False)
    assert log.count() == 5 and log.where("value IS NULL").count() == 1


def test_envelope_shape(spark):
    body = envelope(F.lit("c"), F.lit(None).cast("struct<id:bigint>"), F.struct(F.lit(1).alias("id")))
    text = spark.range(1).select(message(body)).first()[0]
    assert json.loads(text) == {"payload": {"op": "c", "ts_ms": 0, "before": None, "after": {"id": 1}}}


def test_generations_come_one_after_another(spark):
    log = spark.createDataFrame([("t", 0, -1, "s"), ("t", 0, 0, "a"), ("t", 0, 900, "b")], RAW_LOG)
    again = in_generation(log, 1)
    lowest, highest = again.agg({"offset": "min"}).first()[0], in_generation(log, 0).agg({"offset": "max"}).first()[0]
    assert lowest > highest and [r.value for r in again.orderBy("offset").collect()] == ["s", "a", "b"]
    assert again.schema["offset"].dataType == log.schema["offset"].dataType
    with pytest.raises(Exception, match="beyond its generation"):
        in_generation(spark.createDataFrame([("t", 0, LIFE, "x")], RAW_LOG), 1).collect()
    with pytest.raises(ValueError):
        in_generation(log, -1)
