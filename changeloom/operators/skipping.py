"""Targets written in ranges of their key, so that looking up some keys opens few files.

The ranges are folders, with a table of their bounds beside them. The keys that are wanted are first placed among the bounds; only the ranges
they fall into are scanned. Inside a file, row groups are skipped by their least and greatest key and, for keys that lie scattered, by a bloom
filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from changeloom.session import ensure_checkpoint_dir

RANGE = "key_range"


def write(rows: DataFrame, path: str, key: str, ranges: int) -> None:
    """Replace the table at ``path`` by ``rows``, dealt out to about ``ranges`` ranges of ``key`` of equal size. Null keys are in the first one."""
    ensure_checkpoint_dir(rows.sparkSession)
    # The ranges are taken from a sample; checkpointed, so that a lost task cannot be dealt others.
    dealt = rows.repartitionByRange(ranges, key).sortWithinPartitions(key).withColumn(RANGE, F.spark_partition_id()).checkpoint()
    bloom = {"parquet.bloom.filter.enabled#" + key: "true", "parquet.block.size": str(16 << 20)}
    dealt.write.mode("overwrite").options(**bloom).partitionBy(RANGE).parquet(f"{path}/rows")
    dealt.groupBy(RANGE).agg(F.min(key).alias("low"), F.max(key).alias("high")).coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str, row: StructType) -> DataFrame:
    """The rows of some keys. Keys are distinct first, so repeated ones do not repeat rows; null keys find nothing.

    The bounds, one row for each range, meet the few keys wanted by inequality and are broadcast by their size. The driver gets the numbers
    of the ranges that are hit, at most one for each range, as Spark prunes by a join only where it believes the keys to be few.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    bounds = spark.read.parquet(f"{path}/bounds")
    inside = (F.col(key) >= F.col("low")) & (F.col(key) <= F.col("high"))
    hit = [row[0] for row in wanted.join(bounds, inside).select(RANGE).distinct().collect()]
    stored = spark.read.schema(StructType([*row.fields, StructField(RANGE, IntegerType())])).parquet(f"{path}/rows")
    return stored.where(F.col(RANGE).isin(hit)).join(wanted, key, "left_semi").drop(RANGE)
