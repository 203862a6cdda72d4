"""Totals in a stream's state follow updates, moves and deletes, with and without old images in the log."""

from __future__ import annotations

import json
import random

import pytest
import seeds
from test_streaming import direct, order, random_orders, rows, write_log

from changeloom.plans import sales
from changeloom.registry import CRM, ORDERS
from changeloom.sources.changelog import RAW_LOG, file_log, snapshot_log
from changeloom.streaming.keyed_state import committed
from changeloom.streaming.state_totals import StateTotals, order_summary

NOW = {"availableNow": True}
ONE = CRM.select("orders")
TOPIC = CRM.topic("orders")


def totals(folder, **options):
    return StateTotals(ONE, f"{folder}/state", "cus_id", "amount", "order_at", **{"buckets": 8, **options})


def run(spark, folder, complete=False, **options):
    kept = totals(folder)
    queries = kept.follow(file_log(spark, f"{folder}/log"), complete=complete, trigger=NOW, **options)
    for query in queries:
        query.awaitTermination()
    return kept, queries


def complete_log(seed, size):
    """As ``random_orders``, each change with its whole old image."""
    rng, live, log = random.Random(seed), {}, []
    for offset in range(size):
        key = rng.randrange(40)
        old = live.get(key)
        if old and rng.random() < 0.3:
            log.append((offset, order("d", old)))
            del live[key]
            continue
        new = (key, 0 if rng.random() < 1 / 3 else rng.randrange(8), None if rng.random() < 0.05 else rng.randrange(100), rng.randrange(1000))
        log.append((offset, order("u" if old else "c", old, new)))
        live[key] = new
    return log, live


@pytest.mark.parametrize("complete, seed", [(True, 1), (False, 2)])
def test_totals_follow_a_random_log(spark, folder, complete, seed):
    log, live = (complete_log if complete else random_orders)(seed, 240)
    for start in range(0, 240, 80):
        write_log(spark, folder, [(TOPIC, offset, value) for offset, value in log[start : start + 80]], "log")
        kept, _ = run(spark, folder, complete)
    assert rows(kept.current(spark)) == direct(live)
    assert rows(run(spark, folder, complete)[0].current(spark)) == direct(live)
    first = rows(kept.current(spark, batch=0))
    assert first == direct_of(log[:80], complete)


def direct_of(log, complete):
    live = {}
    for _, value in log:
        body = json.loads(value)
        row = body["after"] or body["before"]
        image = tuple(row[c] for c in ("id", "cus_id", "amount", "order_at"))
        if body["op"] == "d":
            live.pop(image[0], None)
        else:
            live[image[0]] = image
    return direct(live)


def test_repeated_and_late_messages_count_once(spark, folder):
    log, live = random_orders(5, 160)
    for some in (log[60:], log[:60], log[40:120]):
        write_log(spark, folder, [(TOPIC, offset, value) for offset, value in some], "log")
        kept, _ = run(spark, folder)
    assert rows(kept.current(spark)) == direct(live)


def test_maximum_goes_back_when_its_row_goes(spark, folder):
    steps = [
        ([order("c", None, (1, 7, 10, 100)), order("c", None, (2, 7, 5, 200))], {(7, 15, 2, 200)}),
        ([order("u", (2, 7, 5, 200), (2, 8, 6, 150))], {(7, 10, 1, 100), (8, 6, 1, 150)}),
        ([order("d", (1, 7, 10, 100))], {(8, 6, 1, 150)}),
        ([order("c", None, (1, 7, 1, None))], {(7, 1, 1, None), (8, 6, 1, 150)}),
        ([order("u", (2, 8, 6, 150), (2, 8, None, 150))], {(7, 1, 1, None)}),
    ]
    offset = 0
    for number, (messages, expected) in enumerate(steps):
        write_log(spark, folder, [(TOPIC, offset + n, m) for n, m in enumerate(messages)], "log")
        offset += len(messages)
        assert rows(run(spark, folder, complete=True)[0].current(spark)) == expected, number


def test_snapshot_and_tiers(spark, folder):
    tables = seeds.sales(spark)
    snapshot_log(tables["orders"], ORDERS, TOPIC).write.json(folder + "/log")
    kept, _ = run(spark, folder, complete=True)
    assert rows(order_summary(kept.current(spark))) == rows(sales.order_summary(tables["orders"]))


def test_plan_reads_the_log_and_the_state_alone(spark, folder):
    log, _ = complete_log(4, 60)
    write_log(spark, folder, [(TOPIC, offset, value) for offset, value in log], "log")
    kept, (query,) = run(spark, folder, complete=True)
    plan = query._jsq.explainInternal(False)
    assert "StateStoreSave" in plan and plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Python" not in plan
    assert query.recentProgress[-1]["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] > 0
    assert committed(spark, f"{folder}/state/totals") == [0]
    reading = kept.current(spark)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in reading and "FileScan" not in reading


def test_unreadable_messages_and_nothing_yet(spark, folder):
    assert totals(folder).current(spark).count() == 0
    spark.createDataFrame([(TOPIC, 0, 0, order("c", None, (1, 7, 10, 5))), (TOPIC, 0, 1, "garbage")], RAW_LOG).write.json(folder + "/log")
    with pytest.raises(Exception, match="unreadable change"):
        run(spark, folder)
    assert rows(run(spark, folder, on_bad="skip")[0].current(spark)) == {(7, 10, 1, 5)}
