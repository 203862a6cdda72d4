"""Grouped totals that follow a changing table, kept in the state of a streaming aggregation.

Every change becomes up to two signed rows: -1 for the image it replaces, +1 for the one it brings. They are summed by group and value of
``latest``. Sums and counts follow by adding up; the maximum of a group is its largest ``latest`` whose weight is above 0, so
when a row that held the maximum goes, the next one is already there and no source is read again. A batch costs its own rows.

Where every message carries the whole image it replaces, the signed rows come from the log itself. Where some do not, a stateful step before
keeps each row's last image; the signed rows then pass through a table of files, which Spark's file sink writes exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from changeloom import files
from changeloom.functions.tiers import HIGH_VALUE_FROM, VIP_FROM, value_tier
from changeloom.registry import Registry, Table
from changeloom.session import empty_frame
from changeloom.sources.changelog import variant_changes, variant_field
from changeloom.streaming.keyed_state import EVERY_MINUTE, committed, read_state, started

TOTAL, COUNT, LAST = "total_amount", "order_count", "last_order_at"
SIGNED = "weight bigint, grp string, measure bigint, latest bigint"


@dataclass(frozen=True)
class StateTotals:
    """Sum of ``measure``, number of rows and maximum of ``latest`` per ``group`` of the only table of ``registry``.

    Rows without a group or a measure do not count. Measure and ``latest`` are whole numbers. Below ``checkpoint`` lie the
    checkpoints of the query or the two queries, and the signed rows between these.
    """

    registry: Registry
    checkpoint: str
    group: str
    measure: str
    latest: str
    buckets: int = 1024
    """Where old images come from the state: keys are kept together in so many buckets. Choose it once, for about a thousand keys in each."""

    @property
    def table(self) -> Table:
        (table,) = self.registry
        return table

    def follow(
        self, log: DataFrame, *, complete: bool = False, trigger: Mapping[str, object] = EVERY_MINUTE, on_bad: str = "raise", name: str | None = None
    ) -> list[StreamingQuery]:
        """Keep the totals up to date with ``log``.

        ``complete`` says that each change is in the log once and with its whole old image: one query then does all, natively. Otherwise a first
        query keeps the last image of every key, drops what was seen before, and hands signed rows to the second one.
        """
        changes = variant_changes(log, self.registry, on_bad)
        if complete:
            return [self._sum(self._from_images(changes), trigger, name)]
        spark = log.sparkSession
        path = f"{self.checkpoint}/signed"
        first = self._from_state(changes).writeStream.outputMode("append").format("parquet").option("path", path)
        keyed = started(first, spark, f"{self.checkpoint}/images", trigger, name and f"{name}_images")
        if "availableNow" in trigger:
            keyed.awaitTermination()  # the second query takes what is there when it starts
            if keyed.exception():
                raise keyed.exception()
        files.make(spark, path)
        signed = spark.readStream.schema(SIGNED).parquet(path)
        return [keyed, self._sum(signed, trigger, name)]

    def current(self, spark: SparkSession, batch: int | None = None) -> DataFrame:
        """The totals of every group that has rows, as of the last batch or an earlier one."""
        schema = self.table.row_type
        kinds = StructType([schema[self.group], StructField(TOTAL, LongType()), StructField(COUNT, LongType()), StructField(LAST, schema[self.latest].dataType)])
        if not committed(spark, f"{self.checkpoint}/totals"):
            return empty_frame(spark, kinds)
        # Both sums have the same name in the state; a cast goes by their order.
        sums = F.col("value").cast("struct<weight: bigint, total: bigint>").alias("sums")
        kept = read_state(spark, f"{self.checkpoint}/totals", batch).select("key", sums).select("key.*", "sums.*")
        sums = kept.where("weight <> 0 OR total <> 0").groupBy("grp").agg(
            F.sum("total").cast("bigint").alias(TOTAL), F.sum("weight").cast("bigint").alias(COUNT), F.max(F.when(F.col("weight") > 0, F.col("latest"))).alias(LAST)
        )
        return sums.where(F.col(COUNT) > 0).select(F.col("grp").cast(schema[self.group].dataType).alias(self.group), TOTAL, COUNT, F.col(LAST).cast(schema[self.latest].dataType))

    def _sum(self, signed: DataFrame, trigger: Mapping[str, object], name: str | None) -> StreamingQuery:
        sums = signed.groupBy("grp", "latest").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("measure")).alias("total"))
        return started(sums.writeStream.outputMode("update").format("noop"), signed.sparkSession, f"{self.checkpoint}/totals", trigger, name)

    def _fields(self, image: str) -> list[Column]:
        """Group, measure and ``latest`` of an image; the measure is NULL where the row does not count."""
        part = lambda name, kind: variant_field(image, name, kind)
        group = part(self.group, "string")
        return [group.alias("grp"), F.when(group.isNotNull(), part(self.measure, "bigint")).alias("measure"), part(self.latest, "bigint").alias("latest")]

    def _from_images(self, changes: DataFrame) -> DataFrame:
        """Signed rows out of complete images, without any state."""

        def image(side: str, weight: int) -> Column:
            return F.struct(F.lit(weight).cast("bigint").alias("weight"), *self._fields(side))

        # A change that brings a row has nothing to take back, whatever else it carries.
        old = F.col("op").isin("u", "d")
        images = changes.select(F.explode(F.array(F.when(old, image("before", -1)), image("row", 1))).alias("i")).select("i.*")
        return images.where("measure IS NOT NULL")

    def _from_state(self, changes: DataFrame) -> DataFrame:
        """Signed rows against the last image of each key; a change at or below the offset last seen of its key gives none."""
        plain = changes.select("key", "offset", *self._fields("row"))
        # One text for each image, empty where it does not count. Keys share a bucket, as a call of Python for each would cost milliseconds.
        packed = plain.select("key", "offset", F.when(F.col("measure").isNotNull(), F.to_json(F.struct("grp", "measure", "latest"))).otherwise("").alias("image"))

        def signed(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            new = pd.concat(list(frames))[["key", "offset", "image"]].sort_values("offset", kind="stable").drop_duplicates("key", keep="last")
            if state.exists:
                known = pa.ipc.open_stream(state.get[0]).read_pandas()
                new = new.merge(known, "left", "key", suffixes=("", "_before"))
                new = new[~(new["offset_before"] >= new["offset"])]
                rest = known[~known["key"].isin(new["key"])]
            else:
                new, rest = new.assign(image_before=None), new.iloc[:0]
            kept = pa.Table.from_pandas(pd.concat([rest, new[["key", "offset", "image"]]]), preserve_index=False)
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, kept.schema) as writer:
                writer.write_table(kept)
            state.update((out.getvalue().to_pybytes(),))
            for weight, name in ((-1, "image_before"), (1, "image")):
                images = new[name].dropna()
                images = images[images != ""]
                if len(images):
                    yield pd.DataFrame({"weight": weight, "image": images})

        dealt = packed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)))
        images = dealt.groupBy("bucket").applyInPandasWithState(signed, "weight bigint, image string", "known binary", "append", GroupStateTimeout.NoTimeout)
        fields = "grp string, measure bigint, latest bigint"
        return images.select("weight", F.from_json("image", fields).alias("i")).select("weight", "i.*")


def order_summary(totals: DataFrame, vip: int = VIP_FROM, high: int = HIGH_VALUE_FROM) -> DataFrame:
    """Totals of orders per customer with their value tier."""
    return totals.select("cus_id", TOTAL, COUNT, value_tier(F.col(TOTAL), vip, high).alias("status"), LAST)
