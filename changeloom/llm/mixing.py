"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from changeloom.llm.frames import row, unpack, word_count

WEIGHTS = (5, 2, 1)
#: The mix takes 3/2 of all words; no source is taken more than twice.
SHARE, MOST = (3, 2), 2
SLICES = 16
#: A size class is the number of bits of a size and its first six: 32 classes to an octave.
LEADING = 6


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` -> ``target``: weights in turn, stopped at the cap, the excess reshared by weight.

    Sources are filled in the order in which they reach their caps: a source is capped if its share of what is left, after
    the caps before it, is above its own cap. All comparisons are of whole numbers. One row per source is all that this sees.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS)).cast("int") + 1)
    full = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    up, down = SHARE
    return (
        sizes.withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * MOST)
        .withColumn("fills_at", F.col("cap") * F.when(F.col("weight") == 5, 2).when(F.col("weight") == 2, 5).otherwise(10))
        .withColumn("all_size", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("capped", F.coalesce(F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("left", F.col("all_size") * up - F.col("capped") * down)
        .withColumn("stops", F.col("left") * F.col("weight") > F.col("cap") * down * F.col("open_weight"))
        # What is left at the first source below its cap holds for all later ones.
        .withColumn("first", F.min(F.when(~F.col("stops"), F.struct("fills_at", "left", "open_weight"))).over(Window.partitionBy()))
        .withColumn(
            "target",
            F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(
                (F.col("first.left") * F.col("weight")).cast("double") / (F.col("first.open_weight") * down).cast("double")
            ),
        )
        .select("source", "source_size", "target")
    )


def offset(source: Column, seed: int) -> Column:
    """The random start of a source, a multiple of 2^-16 in [0, 1)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("double") / 65536.0


def mix(docs: DataFrame, seed: int = 0, size: Column | None = None) -> DataFrame:
    """Every row with its size, its source's size and target, and the copies that the mix takes of it.

    Expected copies, target / source size, are summed up within the source in the order of size class, ``doc_id`` modulo
    16 and ``doc_id``; with the source's random offset added, a row is taken once for each whole number that the sum crosses
    at it. Size classes (32 to an octave) keep the words taken near the target. No row is taken more than twice.

    The prefix sum of a source of any size is a count per class and slice plus a number within these, so that no task sees a
    whole source. Input columns, then ``size``, ``source_size``, ``target``, ``copies``, replacing such names. Null or empty text: size
    0. Null source: a source of its own, last in order. Null ``doc_id``: in slice 0, first. Rows alike in all of these: in any order,
    which changes no total. No rows give no rows.
    """
    rows = docs.select(
        row(docs).alias("row"), F.col("source"), F.col("doc_id"),
        (word_count(F.col("text")) if size is None else size).alias("size"),
    )
    bits = F.length(F.bin("size"))
    rows = rows.select(
        "row", "size", "doc_id",
        F.isnull("source").alias("none"), F.coalesce("source", F.lit("")).alias("name"),
        (bits * 2**LEADING + F.expr(f"cast(shiftright(size, greatest(length(bin(size)) - {LEADING}, 0)) as int)")).alias("class"),
        F.coalesce(F.pmod("doc_id", F.lit(SLICES)), F.lit(0)).alias("slice"),
    )
    group = ["none", "name", "class", "slice"]
    counted = rows.groupBy(*group).agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    source = F.when(~F.col("none"), F.col("name"))
    sized = counted.groupBy("none", "name").agg(F.sum("words").alias("source_size"))
    aims = targets(sized.select(source.alias("source"), "source_size")).select(
        F.isnull("source").alias("none"), F.coalesce("source", F.lit("")).alias("name"), "source_size", "target"
    )
    earlier = Window.partitionBy("none", "name").orderBy("class", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .join(aims, ["none", "name"])
        .select(*group, "before", "source_size", "target", offset(source, seed).alias("start"))
    )
    nth = F.row_number().over(Window.partitionBy(*group).orderBy("doc_id", "size")) - 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    crossed = F.floor(F.col("start") + rate * (F.col("at") + 1)) - F.floor(F.col("start") + rate * F.col("at"))
    return (
        rows.withColumn("nth", nth)
        .join(starts, group)
        .withColumn("at", F.col("nth") + F.col("before"))
        .withColumn("copies", F.least(crossed, F.ceil(rate)).cast("int"))
        .select(*unpack(docs.columns, ("size", "source_size", "target", "copies")))
    )


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the input's columns."""
    names = docs.columns
    taken = mix(docs.select(row(docs).alias("row"), "doc_id", "text", "source"), seed)
    return taken.where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*unpack(names, ()))
