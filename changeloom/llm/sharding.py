"""Reproducible shuffling into shards: a keyed permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from changeloom.llm.frames import row, unpack

ROUNDS = 8
#: Row numbers are counted in 2^16 ranges of the order hash: the one thing that goes through the driver.
RANGE_BITS = 16


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = x ^ np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A keyed permutation of 0 .. n-1 and its inverse.

    A Feistel network permutes the least power of two that is not below n; numbers that come out at n or more are sent
    through again until they are below it, which takes less than two passes on average and keeps it a permutation.
    """

    def __init__(self, n: int, seed: int):
        bits = max(2, (n - 1).bit_length())
        self.n, self.low = n, bits // 2
        self.masks = np.uint64((1 << (bits - self.low)) - 1), np.uint64((1 << self.low) - 1)
        keys = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.keys = [int(k) for k in _mixed(keys, seed & (2**64 - 1))]

    def _pass(self, x: np.ndarray, keys: list[tuple[int, int]]) -> np.ndarray:
        halves = [x >> np.uint64(self.low), x & self.masks[1]]
        for i, key in keys:
            halves[i % 2] = halves[i % 2] ^ (_mixed(halves[1 - i % 2], key) & self.masks[i % 2])
        return (halves[0] << np.uint64(self.low)) | halves[1]

    def _walk(self, x: np.ndarray, keys: list[tuple[int, int]]) -> np.ndarray:
        out = self._pass(x.astype(np.uint64), keys)
        while len(beyond := np.flatnonzero(out >= np.uint64(self.n))):
            out[beyond] = self._pass(out[beyond], keys)
        return out.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, list(enumerate(self.keys)))

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, list(enumerate(self.keys))[::-1])


def shard(docs: DataFrame, shards: int, identity: Sequence[str], seed: int = 0, order: Column | None = None) -> DataFrame:
    """Every row with its place in a shuffle and in one of ``shards`` shards, whose row counts are at most one apart.

    Rows are numbered by a hash of the ``identity`` columns (``order``, if given, is that hash), ties by these columns.
    The numbers are permuted; the shuffled place p is slot ``p div shards`` of shard ``p mod shards``. Any row's place can be computed
    from its number, and ``Permutation.inverse`` gives the row number at a place. The result does not depend on
    partitions or on the number of executors.

    The input's columns, then ``position``, ``shard`` and ``slot``, which replace columns of the same name. Nulls hash like
    values. Rows equal in all identity columns take neighbouring numbers in any order. No rows give no rows.
    """
    hashed = F.xxhash64(*[F.col(f"`{name}`") for name in identity]) if order is None else order
    rows = docs.select(row(docs).alias("row"), hashed.alias("key"))
    rows = rows.withColumn("range", F.shiftrightunsigned("key", 64 - RANGE_BITS).cast("int"))
    counted = rows.groupBy("range").count().toPandas().sort_values("range")  # 2^16 rows at most
    n = int(counted["count"].sum())
    before = (counted["count"].cumsum() - counted["count"]).tolist()
    starts = docs.sparkSession.createDataFrame(
        list(zip(counted["range"].tolist(), before, strict=True)), "range int, before bigint"
    )
    ties = [F.col(f"row.`{name}`") for name in identity]
    number = F.row_number().over(Window.partitionBy("range").orderBy("key", *ties)) - 1
    permutation = Permutation(max(n, 1), seed)

    @F.pandas_udf("bigint")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(numbers.to_numpy()))

    placed = (
        rows.withColumn("nth", number)
        .join(F.broadcast(starts), "range")
        .withColumn("position", place(F.col("nth") + F.col("before")))
        .withColumn("shard", (F.col("position") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("position") / F.lit(shards)).cast("bigint"))
    )
    return placed.select(*unpack(docs.columns, ("position", "shard", "slot")))
