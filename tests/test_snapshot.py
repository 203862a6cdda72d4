"""A snapshot in chunks, taken while changes go on, leads to the table that the source has."""

from __future__ import annotations

import json
import random

import pytest
from test_keyed_state import rows

from changeloom.registry import Registry, Table
from changeloom.sources import snapshot
from changeloom.sources.changelog import RAW_LOG, changes, file_log
from changeloom.streaming.keyed_state import KeyedState

KV = Table("kv", ("k",), "k bigint, v string")
ONE = Registry("p", "s", (KV,))
TOPIC = ONE.topic("kv")


class Database:
    """A table under changes, with the log of those since its capture began."""

    def __init__(self, seed, keys=60):
        self.rng = random.Random(seed)
        self.table = {k: f"old{k}" for k in range(0, keys, 2)}
        self.keys, self.log, self.end = keys, [], 0

    def change(self, times):
        for _ in range(times):
            k = 7 if self.rng.random() < 1 / 3 else self.rng.randrange(self.keys)
            self.end += 1
            if k in self.table and self.rng.random() < 0.4:
                body = {"op": "d", "before": {"k": k, "v": self.table.pop(k)}, "after": None}
            else:
                body = {"op": "u" if k in self.table else "c", "before": None, "after": {"k": k, "v": f"v{self.end}"}}
                self.table[k] = f"v{self.end}"
            self.log.append((self.end, json.dumps(body)))

    def frame(self, spark):
        return spark.createDataFrame(list(self.table.items()), KV.row_type)

    def changes(self, spark, low, high):
        return changes(spark.createDataFrame([(TOPIC, 0, o, v) for o, v in self.log if low < o <= high], RAW_LOG), KV)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_interleavings(spark, folder, seed):
    db = Database(seed)
    todo = snapshot.chunks(db.frame(spark), "k", 8)
    assert len(todo) >= 3

    def read(chunk):
        found = db.frame(spark)  # the rows as of now
        db.change(db.rng.randrange(12))
        return found

    def end():
        db.change(db.rng.randrange(6))
        return db.end

    snapshot.take(spark, read, todo, end, lambda low, high: db.changes(spark, low, high), KV, TOPIC, f"{folder}/snapshot")
    db.change(20)
    read_rows = spark.read.schema(f"{RAW_LOG}, chunk int").json(f"{folder}/snapshot").collect()
    # In the order of the log, the snapshot's messages coming behind those at the same offset.
    arrived = sorted([(o, 0, v) for o, v in db.log] + [(r.offset, 1, r.value) for r in read_rows])
    table = {}
    for _, _, value in arrived:
        body = json.loads(value)
        body = body.get("payload", body)
        if body["op"] == "d":
            table.pop(body["before"]["k"], None)
        else:
            table[body["after"]["k"]] = body["after"]["v"]
    assert table == db.table


def test_rows_changed_between_the_marks_are_left_to_the_log(spark):
    held = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 1)], "k bigint, v string, chunk bigint")
    marks = spark.createDataFrame([(0, 10, 20), (1, 30, 40)], snapshot.MARKS)
    log = [(10, 1), (11, 2), (21, 1), (20, 3), (41, 3)]
    messages = [(TOPIC, 0, o, json.dumps({"op": "u", "after": {"k": k, "v": "new"}})) for o, k in log]
    found = snapshot.settled(held, marks, changes(spark.createDataFrame(messages, RAW_LOG), KV), KV, TOPIC)
    assert {(json.loads(r.value)["payload"]["after"]["k"], r.offset) for r in found.collect()} == {(1, 20), (3, 40)}


def test_goes_on_where_it_stopped_and_streams(spark, folder):
    db, reads = Database(5), []
    todo = snapshot.chunks(db.frame(spark), "k", 10)

    def read(chunk):
        reads.append(chunk.number)
        if len(reads) == 2:
            raise RuntimeError("the machine went away")
        return db.frame(spark)

    def go():
        return snapshot.take(spark, read, todo, lambda: db.end, lambda low, high: db.changes(spark, low, high), KV, TOPIC, f"{folder}/log/snapshot")

    with pytest.raises(RuntimeError):
        go()
    db.change(30)
    assert go() == todo
    spark.createDataFrame([(TOPIC, 0, o, v) for o, v in db.log], RAW_LOG).write.json(f"{folder}/log/changes", ignoreNullFields=False)
    kept = KeyedState(ONE, f"{folder}/c")
    log = file_log(spark, f"{folder}/log/*/chunk=*").unionByName(file_log(spark, f"{folder}/log/changes"))
    kept.follow(log, trigger={"availableNow": True}).awaitTermination()
    assert rows(kept.current(spark, "kv")) == set(db.table.items())


def test_chunks(spark):
    frame = spark.range(1000).withColumnRenamed("id", "k")
    todo = snapshot.chunks(frame, "k", 100)
    counts = [frame.where(c.holds(frame["k"])).count() for c in todo]
    assert sum(counts) == 1000 and 5 <= len(todo) <= 20 and max(counts) < 400
    assert snapshot.chunks(frame.limit(0), "k", 10) == [snapshot.Chunk(0, None, None)]
