"""Facts and their dimension saved side by side: both bucketed and sorted by the join key, so that joining them moves no row.

A key with more rows than a bucket should hold is hot. Its facts get one of some salts each, its dimension row one copy per salt, and both
tables are bucketed by key and salt, so a hot key is spread over as many buckets as there are salts. Hot keys are counted, not guessed; there are
fewer of them than buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

SALT = "_salt"


@dataclass(frozen=True)
class Colocated:
    """Saved tables ``<name>_facts``, ``<name>_dimension`` and ``<name>_hot`` of the catalogue, their files below ``root``.

    Choose ``buckets`` so that a bucket of facts is 0.5 to 1 GB; it is fixed for the tables' life.
    """

    name: str
    root: str
    key: str
    buckets: int
    salts: int = 16

    def save(self, facts: DataFrame, dimension: DataFrame) -> None:
        """Write all three tables anew. Facts and dimension rows without a key join nothing and are left out. The dimension has one row per key."""
        counts = facts.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        total = facts.count()
        self._write(counts.where(F.col("n") * self.buckets > total).select(self.key).coalesce(1), "hot")
        self.add(facts, "overwrite")
        hot = facts.sparkSession.table(f"{self.name}_hot").select(self.key, F.lit(True).alias("_is_hot"))
        marked = dimension.where(F.col(self.key).isNotNull()).join(hot, self.key, "left")
        copies = F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(self.salts - 1))).otherwise(F.array(F.lit(0)))
        self._write(marked.withColumn(SALT, F.explode(copies)).drop("_is_hot"), "dimension", bucketed=True)

    def add(self, facts: DataFrame, mode: str = "append") -> None:
        """More facts, by the hot keys that are known."""
        hot = facts.sparkSession.table(f"{self.name}_hot").select(self.key, F.lit(True).alias("_is_hot"))
        marked = facts.where(F.col(self.key).isNotNull()).join(hot, self.key, "left")
        dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(self.salts)).cast("int")
        salted = marked.withColumn(SALT, F.when(F.col("_is_hot"), dealt).otherwise(0)).drop("_is_hot")
        self._write(salted, "facts", bucketed=True, mode=mode)

    def joined(self, spark: SparkSession) -> DataFrame:
        """Facts with their dimension; the key comes first."""
        facts, dimension = spark.table(f"{self.name}_facts"), spark.table(f"{self.name}_dimension")
        # A merge of buckets that are sorted already; a broadcast of a large dimension would cost more.
        return facts.hint("merge").join(dimension, [self.key, SALT]).drop(SALT)

    def drop(self, spark: SparkSession) -> None:
        for part in ("facts", "dimension", "hot"):
            spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")

    def _write(self, frame: DataFrame, part: str, bucketed: bool = False, mode: str = "overwrite") -> None:
        if bucketed:
            # One file for each bucket: a bucket of several sorted files would have to be sorted again.
            frame = frame.repartition(self.buckets, self.key, SALT)
        writer = frame.write.mode(mode).format("parquet").option("path", f"{self.root}/{part}")
        if bucketed:
            writer = writer.bucketBy(self.buckets, self.key, SALT).sortBy(self.key, SALT)
        writer.saveAsTable(f"{self.name}_{part}")
