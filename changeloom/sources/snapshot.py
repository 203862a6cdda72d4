"""The initial snapshot of a table in chunks of its key, taken while changes go on.

A chunk is read between two marks of the change log: the offset the log has reached before the read and the one after it. What was logged up
to the low mark is in the rows that were read; what comes after the high mark is newer than they are. In between, either may be the
newer one, so rows whose key was changed there are dropped: the log has them. The others are placed at the high mark. No table is locked,
the log goes on, and a snapshot that stops begins again at the chunk it was in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeloom import files
from changeloom.registry import Table
from changeloom.sources.changelog import placed_log

MARKS = "chunk bigint, low bigint, high bigint"


@dataclass(frozen=True)
class Chunk:
    """Keys from ``first`` on, and below ``end``; None is open."""

    number: int
    first: object | None
    end: object | None

    def holds(self, key: Column) -> Column:
        inside = F.lit(True)
        if self.first is not None:
            inside = inside & (key >= F.lit(self.first))
        return inside if self.end is None else inside & (key < F.lit(self.end))


def chunks(rows: DataFrame, key: str, size: int) -> list[Chunk]:
    """Ranges of the key with about ``size`` rows each: only their bounds meet on the driver. The first and the last are open, so keys that come later are in one too."""
    count = -(-rows.count() // size)
    if count < 2:
        return [Chunk(0, None, None)]
    dealt = rows.select(key).where(F.col(key).isNotNull()).repartitionByRange(count, key)
    first = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("first")).orderBy("first")
    bounds = [row["first"] for row in first.collect()][1:]
    return [Chunk(n, low, high) for n, (low, high) in enumerate(zip([None, *bounds], [*bounds, None], strict=True))]


def settled(rows: DataFrame, marks: DataFrame, changes: DataFrame, table: Table, topic: str, wrapped: bool = True) -> DataFrame:
    """Chunks as snapshot messages that can be applied in the order of the log.

    ``rows`` are those read, with their ``chunk``; ``marks`` has ``chunk``, ``low`` and ``high``; ``changes`` are the typed changes of the
    table from the first low mark to the last high mark. Rows join their marks by chunk and the changes by key; nothing is collected.
    """
    marked = rows.join(marks, "chunk")
    changed = changes.select(*table.key, F.col("offset").alias("_at"))
    same = [F.col(f"r.{k}") == F.col(f"c.{k}") for k in table.key]
    between = (F.col("c._at") > F.col("r.low")) & (F.col("c._at") <= F.col("r.high"))
    kept = marked.alias("r").join(changed.alias("c"), [*same, between], "left_anti")
    return placed_log(kept, table, topic, "high", wrapped)


def take(
    spark: SparkSession,
    read: Callable[[Chunk], DataFrame],
    todo: Sequence[Chunk],
    log_end: Callable[[], int],
    changes: Callable[[int, int], DataFrame],
    table: Table,
    topic: str,
    path: str,
) -> list[Chunk]:
    """Read chunk after chunk and write each one's messages below ``path``, where the stream reads them; returns the chunks done.

    ``read`` reads the present rows of a chunk, e.g. over JDBC; ``log_end`` tells the offset the log has reached; ``changes`` gives the typed
    changes after one offset up to another. A chunk counts once its folder is complete, so the call goes on where an earlier one stopped.
    """
    done = []
    for chunk in todo:
        target, held = f"{path}/chunk={chunk.number}", f"{path}/_read/{chunk.number}"
        if not files.written(spark, target):
            low = log_end()
            rows = read(chunk).where(chunk.holds(F.col(table.key[0])))
            # What is read is kept before the high mark is taken, so that it cannot be read again, and newer, after it.
            rows.withColumn("chunk", F.lit(chunk.number).cast("bigint")).write.mode("overwrite").parquet(held)
            high = log_end()
            marks = spark.createDataFrame([(chunk.number, low, high)], MARKS)
            messages = settled(spark.read.parquet(held), marks, changes(low, high), table, topic)
            messages.write.mode("overwrite").json(target, ignoreNullFields=False)
        done.append(chunk)
    return done
