"""Upserts by ``MERGE INTO``, for a catalogue with a lake format that supports it.

Only the statement is tested, by Spark's parser: no such format is on the classpath here. The table needs the target columns, ``_op string``
and ``_seq bigint``. Deleted keys stay as tombstones, so that a replayed older change cannot bring them back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from changeloom.operators.changes import OP, SEQ, latest_per_key
from changeloom.registry import Table
from changeloom.sources.changelog import changes


def merge_statement(table: str, source: str, key: Sequence[str], columns: Sequence[str]) -> str:
    stored = [*columns, OP, SEQ]
    same = " AND ".join(f"t.`{k}` = s.`{k}`" for k in key)
    assign = ", ".join(f"t.`{c}` = s.`{c}`" for c in stored if c not in key)
    names = ", ".join(f"`{c}`" for c in stored)
    values = ", ".join(f"s.`{c}`" for c in stored)
    return (
        f"MERGE INTO {table} t USING {source} s ON {same} "
        f"WHEN MATCHED AND s.`{SEQ}` > t.`{SEQ}` THEN UPDATE SET {assign} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


class MergeTable:
    """A target of ``writeStream.foreachBatch(MergeTable(...).follow(table))``, kept by its format instead of a stream's state."""

    def __init__(self, spark: SparkSession, table: str, key: Sequence[str], columns: Sequence[str]):
        self.spark, self.table, self.key, self.columns = spark, table, tuple(key), tuple(columns)

    def follow(self, captured: Table, on_bad: str = "raise") -> Callable[[DataFrame, int], None]:
        """Brings a batch of raw messages of one table into the target; running it again has no further effect."""

        def write(batch: DataFrame, number: int) -> None:
            latest = latest_per_key(changes(batch, captured, on_bad), captured.key, captured.row_type)
            self.put(captured.project_latest(latest))

        return write

    def put(self, latest: DataFrame) -> None:
        view = f"merge_source_{uuid.uuid4().hex}"
        latest.createOrReplaceTempView(view)
        latest.sparkSession.sql(merge_statement(self.table, view, self.key, self.columns))
        latest.sparkSession.catalog.dropTempView(view)

    def current(self) -> DataFrame:
        return self.spark.table(self.table).where(f"{OP} <> 'd'").select(*self.columns)
