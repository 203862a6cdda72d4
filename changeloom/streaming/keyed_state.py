"""Tables kept as the state of a stream: the last row of every key, in Spark's own state store.

One streaming query groups the changes of any number of tables by table and key and keeps the last image, as VARIANT. The checkpoint of
the query is the table: a batch is committed with its offsets, once, and the state is read back with Spark's ``statestore``
source, as of the last batch or an earlier one. Nothing else is written, so there is nothing to compact or to clean up. Deleted keys
stay as such in the state, so that a replayed older change cannot bring them back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from changeloom import files
from changeloom.registry import Registry, Table
from changeloom.session import empty_frame
from changeloom.sources.changelog import bad_variants, variant_changes

EVERY_MINUTE = {"processingTime": "60 seconds"}
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on the executors' disks, and not on the heap."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def started(writer: DataStreamWriter, spark: SparkSession, checkpoint: str, trigger: Mapping[str, object], name: str | None = None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger)
    with rocksdb(spark):
        return (writer.queryName(name) if name else writer).start()


def committed(spark: SparkSession, checkpoint: str) -> list[int]:
    """The batches that are done."""
    return sorted(int(name) for name in files.children(spark, f"{checkpoint}/commits") if name.isdigit())


def read_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The state of a query with one stateful operator: ``key`` and ``value`` as it keeps them."""
    reader = spark.read.format("statestore")
    return (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)


def last_images(changes: DataFrame) -> DataFrame:
    """The last change of every key. Each task reduces its own changes first, so a key with any share of the log sends one row per task."""
    return changes.groupBy("topic", "key").agg(F.expr("max_by(struct(op, row), offset) AS last"))


def set_aside(log: DataFrame, registry: Registry, path: str, checkpoint: str, *, trigger: Mapping[str, object] = EVERY_MINUTE) -> StreamingQuery:
    """A query that keeps the unreadable messages of a log, as they came, below ``path``."""
    bad = bad_variants(log, registry).writeStream.format("parquet").option("path", path)
    return bad.option("checkpointLocation", checkpoint).trigger(**trigger).start()


@dataclass(frozen=True)
class KeyedState:
    """The tables of a registry in the state of one query, below ``checkpoint``."""

    registry: Registry
    checkpoint: str

    def follow(self, log: DataFrame, *, trigger: Mapping[str, object] = EVERY_MINUTE, on_bad: str = "raise", name: str | None = None) -> StreamingQuery:
        """Keep the tables up to date with ``log``; the same call goes on after a restart.

        The state has as many parts as ``spark.sql.shuffle.partitions`` said when the checkpoint was new; choose it so that a part is
        a few GB. A log whose topics are created anew goes on in the same checkpoint with ``in_generation``.
        """
        latest = last_images(variant_changes(log, self.registry, on_bad))
        return started(latest.writeStream.outputMode("update").format("noop"), log.sparkSession, self.checkpoint, trigger, name)

    def latest(self, spark: SparkSession, batch: int | None = None) -> DataFrame | None:
        """``topic``, ``key``, ``op``, ``row`` and ``offset`` of every key, as of the last batch or ``batch``; None before the first one."""
        if not committed(spark, self.checkpoint):
            return None
        kept = read_state(spark, self.checkpoint, batch)
        last = "value.valueWithExtremumOrdering"
        return kept.selectExpr("key.topic AS topic", "key.key AS key", f"{last}.op AS op", f"{last}.row AS row", "value.extremumOrdering AS offset")

    def captured(self, spark: SparkSession, table: Table | str, batch: int | None = None) -> DataFrame:
        """The present rows of one table as they were captured. Columns that a row lacks are NULL."""
        table = self.registry[table] if isinstance(table, str) else table
        latest = self.latest(spark, batch)
        if latest is None:
            return empty_frame(spark, table.row_type)
        own = latest.where((F.col("topic") == self.registry.topic(table)) & (F.col("op") != "d"))
        return own.select(F.col("row").cast(table.row_type).alias("row")).select("row.*")

    def current(self, spark: SparkSession, table: Table | str, batch: int | None = None) -> DataFrame:
        """The present rows of one target."""
        table = self.registry[table] if isinstance(table, str) else table
        return table.project(self.captured(spark, table, batch))


def follow_groups(
    source: Callable[[Registry], DataFrame], registry: Registry, checkpoint: str, *, group_size: int = 5, **options
) -> tuple[list[KeyedState], list[StreamingQuery]]:
    """One query per ``group_size`` tables, each with its own checkpoint; size 1 gives one query per table.

    ``source`` opens the log of a group, e.g. ``lambda group: kafka_log(spark, servers, group)``.
    """
    kept = states(registry, checkpoint, group_size)
    return kept, [state.follow(source(state.registry), **options) for state in kept]


def states(registry: Registry, checkpoint: str, group_size: int = 5) -> list[KeyedState]:
    """Where ``follow_groups`` keeps the tables."""
    return [KeyedState(group, f"{checkpoint}/{number}") for number, group in enumerate(registry.groups(group_size))]


def current_tables(spark: SparkSession, kept: list[KeyedState]) -> dict[str, DataFrame]:
    """The present rows of every table, by captured name."""
    return {t.name: state.current(spark, t) for state in kept for t in state.registry}
