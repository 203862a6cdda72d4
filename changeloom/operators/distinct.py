"""Distinct counts that can be merged: exact bitmaps by group and range of values, stored once and combined at will.

``parts`` keeps, for each group, one bitmap for each 32 768 neighbouring values that occur. Counts over any union of groups (days into months,
categories into all, batches into a table) then come from the bitmaps alone, exactly, without the facts. A bitmap has 4 KB
however few values it holds, so this is for numbers that lie close together, such as keys that are counted up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BUCKET, BITS = "bitmap_bucket", "bitmap"


def parts(rows: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """The bitmaps of a whole-number column by group; NULL values do not count. Tasks combine their own bits first, so large groups spread by value."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*group, F.bitmap_bucket_number(value).alias(BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITS))


def merged(stored: DataFrame, group: Sequence[str]) -> DataFrame:
    """Bitmaps by fewer columns, or of several batches in one."""
    return stored.groupBy(*group, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counts(stored: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """The number of distinct values by group."""
    return merged(stored, group).groupBy(*group).agg(F.sum(F.bitmap_count(BITS)).cast("bigint").alias(name))
