"""Batch writes into a table: upsert, reload, append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeloom.session import ensure_checkpoint_dir


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    on: Sequence[str],
    update: Sequence[str] | None = None,
    sequence: str | None = None,
) -> DataFrame:
    """``target`` after inserting ``incoming``; where ``on`` is taken, only the ``update`` columns change.

    ``on`` is any unique key, not only the primary one; a NULL in it conflicts with nothing. ``update`` defaults to all
    other columns. ``incoming`` has the columns of ``target``, one row per key; with ``sequence`` it may have several,
    which count as inserted in that order: the first one fills a new row, later ones update it.
    """
    columns = target.columns
    changing = [c for c in columns if c not in on] if update is None else list(update)
    fixed = [c for c in columns if c not in on and c not in changing]
    free = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    rows, unkeyed = incoming.where(~free), incoming.where(free).select(*columns)
    if sequence:
        rows = rows.groupBy(*on).agg(
            F.max_by(F.struct(*changing), sequence).alias("last"),
            *([F.min_by(F.struct(*fixed), sequence).alias("first")] if fixed else []),
        )
        rows = rows.select(*on, *[F.col(f"last.{c}") for c in changing], *[F.col(f"first.{c}") for c in fixed])
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = rows.withColumn("_new", F.lit(True)).alias("new")
    merged = old.join(new, [F.col(f"old.{c}") == F.col(f"new.{c}") for c in on], "full_outer")
    was, comes = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()

    def value(c: str) -> Column:
        prefer_new = comes if c in changing else ~was
        return F.when(prefer_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)

    return merged.select(*[value(c) for c in columns]).unionByName(unkeyed)


def upsert_any(
    target: DataFrame, incoming: DataFrame, keys: Sequence[Sequence[str]], update: Sequence[str] | None = None
) -> DataFrame:
    """``target`` after inserting ``incoming``, where each of ``keys`` is unique; the first one is the primary key.

    A row that meets a target row in any key changes that row's ``update`` columns (by default all that are in no key);
    the others are inserted. A NULL in a key conflicts with nothing. It fails if two incoming rows share a key, if two of
    them meet the same target row, or if one meets two different ones. Only keys of ``target`` are compared, by one
    join with the incoming rows per key, which are small beside it and can be broadcast by their size.
    """
    ensure_checkpoint_dir(target.sparkSession)
    primary, columns = list(keys[0]), target.columns
    changing = [c for c in columns if all(c not in key for key in keys)] if update is None else list(update)
    rows = incoming.select(*columns).withColumn("_row", F.monotonically_increasing_id()).checkpoint()

    def single(frame: DataFrame, by: Sequence[str], problem: str) -> None:
        if not frame.groupBy(*by).count().where("count > 1").isEmpty():
            raise ValueError(problem)

    met = []
    for key in keys:
        taken = rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))
        single(taken, key, f"incoming rows share the key {', '.join(key)}")
        hit = F.struct(*[F.col(f"old.{p}").alias(p) for p in primary]).alias("_hit")
        same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key]
        met.append(target.alias("old").join(taken.alias("new"), same).select("new._row", hit))
    hits = reduce(DataFrame.union, met).distinct().checkpoint()
    single(hits, ["_row"], "an incoming row meets several rows of the table by different keys")
    single(hits, ["_hit"], "several incoming rows meet the same row of the table")
    found = rows.join(hits, "_row").select("_hit", F.struct(*changing).alias("_new"))
    merged = target.join(found, [F.col(p) == F.col(f"_hit.{p}") for p in primary], "left")

    def value(c: str) -> Column:
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in changing else F.col(c)

    return merged.select(*[value(c) for c in columns]).unionByName(rows.join(hits, "_row", "left_anti").select(*columns))


def reload(frame: DataFrame, path: str) -> None:
    """Replace the whole table at ``path``. Running it again gives the same table."""
    frame.write.mode("overwrite").parquet(path)


def append(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    order: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """``target`` and ``incoming``, whose rows get default values and the next keys in ``order``.

    ``incoming`` lacks ``key`` and may lack columns that have defaults or may be NULL. The rows are range-partitioned by
    ``order``, numbered inside their partition, and shifted by the sizes of the partitions before. Only these sizes,
    one number per partition, meet in one place. The numbered rows are checkpointed, so that a lost executor cannot
    number them differently the second time; equal ``order`` values are told apart by a hash of the row.
    """
    spark = target.sparkSession
    ensure_checkpoint_dir(spark)
    given = dict(defaults or {})
    wanted = [c for c in target.columns if c != key]
    types = {f.name: f.dataType for f in target.schema.fields}

    def filled(c: str) -> Column:
        fallback = F.lit(given.get(c)).cast(types[c])
        return (F.coalesce(F.col(c), fallback) if c in incoming.columns else fallback).cast(types[c]).alias(c)

    carried = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    tie = F.xxhash64(*incoming.columns).alias("_tie")
    rows = incoming.select(*[filled(c) for c in wanted], *carried, tie)
    sort = [*[f"_o{i}" for i in range(len(order))], "_tie"]
    numbered = (
        rows.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select(
            *wanted,
            F.spark_partition_id().alias("_p"),
            # The lower 33 bits are the position of the row in its partition.
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_i"),
        )
        .checkpoint()
    )
    sizes = numbered.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        "_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before")
    )
    highest = target.agg(F.max(key)).first()[0] or 0
    # One row per partition.
    added = numbered.join(F.broadcast(before), "_p").select(
        (F.lit(highest) + F.col("_before") + F.col("_i") + 1).cast(types[key]).alias(key), *wanted
    )
    return target.unionByName(added)

