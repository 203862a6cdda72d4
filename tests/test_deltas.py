"""Views kept by what changed equal views computed anew; merged distinct counts equal counted ones; replaced tables stay readable."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from changeloom import files
from changeloom.operators import deltas, distinct, generations
from changeloom.plans import incremental, sales

SIGNED_ORDERS = "id bigint, cus_id bigint, amount bigint, order_at bigint, weight bigint"
SIGNED_CUSTOMERS = "cus_id bigint, region string, weight bigint"


def rows(frame):
    return {tuple(r) for r in frame.collect()}


class Shop:
    """Orders and customers under random changes; a third of all orders belong to one customer."""

    def __init__(self, seed):
        self.rng, self.orders, self.customers = random.Random(seed), {}, {c: ("a", c % 3 and f"r{c % 3}" or None) for c in range(12)}

    def change_orders(self, times):
        signed = []
        for _ in range(times):
            key = self.rng.randrange(30)
            old = self.orders.pop(key, None)
            if old:
                signed.append((*old, -1))
            if not old or self.rng.random() < 0.6:
                customer = 1 if self.rng.random() < 1 / 3 else self.rng.choice([*range(14), None])
                new = (key, customer, self.rng.choice([None, *range(50)]), 0)
                self.orders[key] = new
                signed.append((*new, 1))
        return signed

    def move_customers(self, times):
        signed = []
        for c in self.rng.sample(range(12), times):
            old = self.customers[c][1]
            new = self.rng.choice(["r0", "r1", "r2", None])
            self.customers[c] = ("a", new)
            signed += [(c, old, -1), (c, new, 1)]
        return signed

    def expected(self, spark):
        orders = spark.createDataFrame(list(self.orders.values()), "id bigint, cus_id bigint, amount bigint, order_at bigint")
        customers = spark.createDataFrame([(c, r) for c, (_, r) in self.customers.items()], "cus_id bigint, region string")
        return rows(sales.regional_summary(customers, sales.order_summary(orders)).select("region", "total_revenue", "total_orders", "customer_count"))


@pytest.mark.parametrize("seed", [1, 2])
def test_views_follow_random_batches(spark, folder, seed):
    shop = Shop(seed)
    shop.change_orders(40)
    orders = spark.createDataFrame(list(shop.orders.values()), "id bigint, cus_id bigint, amount bigint, order_at bigint")
    customers = spark.createDataFrame([(c, r) for c, (_, r) in shop.customers.items()], "cus_id bigint, region string")
    summary = incremental.summary_of(orders)
    regions = incremental.regions_of(customers, summary)
    for batch in range(3):
        d_orders = spark.createDataFrame(shop.change_orders(15), SIGNED_ORDERS)
        d_customers = deltas.net(spark.createDataFrame(shop.move_customers(3), SIGNED_CUSTOMERS))
        d_summary = incremental.summary_delta(summary, d_orders)
        d_regions = incremental.regions_delta(regions, customers, d_customers, summary, d_summary)
        new = [deltas.applied(r, d, [k]) for r, d, k in ((summary, d_summary, "cus_id"), (customers, d_customers, "cus_id"), (regions, d_regions, "region"))]
        for n, frame in enumerate(new):
            frame.write.parquet(f"{folder}/{batch}/{n}")
        summary, customers, regions = (spark.read.schema(f.schema).parquet(f"{folder}/{batch}/{n}") for n, f in enumerate(new))
        assert rows(regions.select("region", "total_revenue", "total_orders", deltas.ROWS)) == shop.expected(spark), batch


def test_untouched_groups_stay_where_they_are(spark, folder):
    stored = spark.range(1000).selectExpr("id AS cus_id", "id AS total_amount", "1L AS row_count")
    stored.write.parquet(folder + "/summary")
    summary = spark.read.parquet(folder + "/summary")
    spark.createDataFrame([(1, 7, 5, 0, 1), (2, 8, 8, 0, -1), (3, 2000, 1, 0, 1)], SIGNED_ORDERS).write.parquet(folder + "/change")
    orders = spark.read.parquet(folder + "/change")
    found = incremental.summary_delta(summary, orders)
    assert rows(found) == {(7, 7, 1, -1), (7, 12, 2, 1), (8, 8, 1, -1), (2000, 1, 1, 1)}
    found.write.format("noop").mode("overwrite").save()
    text = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The stored rows meet the touched groups right behind their scan; only those that match go on.
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "total_amount" in line)
    semi = next(i for i in range(scan, -1, -1) if "LeftSemi" in lines[i])
    assert not any("Exchange hashpartitioning" in line for line in lines[semi:scan]) and "BroadcastHashJoin" in lines[semi]
    assert sum("FileScan" in line and "total_amount" in line for line in lines) == 1


def test_net_changes_cancel(spark):
    frame = spark.createDataFrame([("a", 1), ("a", -1), ("b", 1), ("b", 1), (None, -1)], "x string, weight bigint")
    assert rows(deltas.net(frame)) == {("b", 2), (None, -1)}


def test_empty_change(spark):
    summary = incremental.summary_of(spark.createDataFrame([(1, 1, 2, 0)], "id bigint, cus_id bigint, amount bigint, order_at bigint"))
    none = incremental.summary_delta(summary, spark.createDataFrame([], SIGNED_ORDERS))
    assert none.count() == 0 and rows(deltas.applied(summary, none, ["cus_id"])) == {(1, 2, 1)}


# Distinct counts


def test_merged_counts_equal_distinct_counts(spark, folder):
    rng = random.Random(3)
    data = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.randrange(4), rng.choice([None, 0, 1, 32_767, 32_768, 32_769, 5_000_000_000, rng.randrange(100_000)])) for _ in range(3000)]
    frame = spark.createDataFrame(data, "g string, day int, v bigint")
    for day in range(4):
        distinct.parts(frame.where(f"day = {day}"), ["g", "day"], "v").write.mode("append").parquet(folder + "/parts")
    stored = spark.read.parquet(folder + "/parts")
    for group in (["g"], ["day"], ["g", "day"], []):
        expected = frame.where("v is not null").groupBy(*group).agg(F.countDistinct("v").alias("n"))
        assert rows(distinct.counts(stored, group, "n")) == rows(expected)
    again = distinct.merged(stored.unionByName(stored), ["g"])
    assert rows(distinct.counts(again, ["g"], "n")) == rows(distinct.counts(stored, ["g"], "n"))
    text = distinct.counts(stored, ["g"], "n")._jdf.queryExecution().executedPlan().toString()
    assert text.split("== Initial Plan ==")[0].count("FileScan") == 1 and "Expand" not in text


# Replacement


def test_reload_that_fails_leaves_the_old_rows(spark, folder):
    table, root = "replaced_table", folder + "/generations"
    first = generations.reload(spark.range(10), table, root)
    before = spark.table(table)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        generations.reload(broken, table, root)
    assert spark.table(table).count() == 10 and generations.current(spark, table).endswith(first.rsplit("/", 1)[-1])
    generations.reload(spark.table(table).where("id < 3"), table, root)
    assert spark.table(table).count() == 3 and before.count() == 10  # who planned before goes on with the old rows
    generations.switch(spark, table, first, spark.range(1))
    assert spark.table(table).count() == 10
    assert len(generations.forget(spark, table, root)) == 2 and files.children(spark, root) == [first.rsplit("/", 1)[-1]]
    with pytest.raises(ValueError):
        generations.reload(spark.range(3).select(F.col("id").cast(IntegerType())), table, root)
    assert spark.table(table).count() == 10
    spark.sql(f"DROP TABLE {table}")
