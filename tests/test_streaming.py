"""Logs and checks that the streaming tests share, and the statement for lake tables."""

from __future__ import annotations

import json
import random

from changeloom.sources.changelog import RAW_LOG
from changeloom.streaming.merge import merge_statement


def rows(frame):
    return {tuple(r) for r in frame.collect()}


def write_log(spark, folder, messages, name):
    lines = [(topic, 0, offset, value) for topic, offset, value in messages]
    spark.createDataFrame(lines, RAW_LOG).coalesce(1).write.mode("append").json(f"{folder}/{name}", ignoreNullFields=False)


def order(op, before=None, after=None):
    def image(row):
        return row and dict(zip(("id", "cus_id", "amount", "order_at"), row))

    return json.dumps({"op": op, "ts_ms": 0, "before": image(before), "after": image(after)})


def random_orders(seed, size):
    """A log of creates, updates, moves between customers and deletes, half of the old images missing."""
    rng, live, log = random.Random(seed), {}, []
    for offset in range(size):
        key = rng.randrange(40)
        customer = 0 if rng.random() < 1 / 3 else rng.randrange(8)
        old = live.get(key)
        if old and rng.random() < 0.3:
            log.append((offset, order("d", old)))
            del live[key]
            continue
        amount = None if rng.random() < 0.05 else rng.randrange(100)
        new = (key, customer, amount, rng.randrange(1000))
        log.append((offset, order("u" if old else "c", old if rng.random() < 0.5 else None, new)))
        live[key] = new
    return log, live


def direct(live):
    sums = {}
    for _, customer, amount, at in live.values():
        if amount is not None:
            sums.setdefault(customer, []).append((amount, at))
    return {(c, sum(a for a, _ in v), len(v), max(at for _, at in v)) for c, v in sums.items()}


def test_merge_statement_is_valid_sql(spark):
    text = merge_statement("lake.orders", "batch", ["id"], ["id", "cus_id", "month"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan
