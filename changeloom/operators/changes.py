"""Operators over typed changes (see ``changeloom.sources.changelog``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

SEQ, OP = "_seq", "_op"


def latest_per_key(changes: DataFrame, key: Sequence[str], row: StructType) -> DataFrame:
    """The last change of every key: key and value columns, ``_op`` and ``_seq`` (its offset).

    Every task first reduces its own changes to one per key, so a key with any share of the log sends one row per
    task through the exchange. The value columns of a deleted row are NULL.
    """
    values = [f for f in row.fieldNames() if f not in key]
    last = changes.groupBy(*key).agg(
        F.expr("max_by(struct(op, if(op = 'd', NULL, after) AS row), offset) AS last"), F.max("offset").alias(SEQ)
    )
    return last.selectExpr(
        *[f"`{k}`" for k in key], *[f"last.row.`{v}` AS `{v}`" for v in values], f"last.op AS {OP}", SEQ
    )


def live(state: DataFrame, row: StructType) -> DataFrame:
    """The rows that exist, without bookkeeping columns."""
    return state.where(f"{OP} <> 'd'").select(*row.fieldNames())


def current_rows(changes: DataFrame, key: Sequence[str], row: StructType) -> DataFrame:
    """The table that a bounded log leads to."""
    return live(latest_per_key(changes, key, row), row)


def weighted(changes: DataFrame, row: StructType) -> DataFrame:
    """Every change as up to two weighted rows: -1 for the image it replaces, +1 for the one it brings.

    Sums and counts over the weights follow updates and deletes. Needs complete ``before`` images; where a source
    does not send them, let a stream's state supply them (``changeloom.streaming.state_totals``).
    """
    old, new = "struct(-1L AS weight, before AS row)", "struct(1L AS weight, after AS row)"
    images = f"CASE op WHEN 'u' THEN array({old}, {new}) WHEN 'd' THEN array({old}) ELSE array({new}) END"
    return (
        changes.selectExpr(f"explode({images}) AS image")
        .where("image.row IS NOT NULL")
        .selectExpr("image.weight AS weight", *[f"image.row.`{c}` AS `{c}`" for c in row.fieldNames()])
    )


def weighted_sum(column: Column) -> Column:
    """Sum of a measure over weighted rows."""
    return F.sum(F.col("weight") * column)


def weighted_count(column: Column | None = None) -> Column:
    """Rows, or rows with a value in ``column``, over weighted rows."""
    return F.sum(F.col("weight") if column is None else F.when(column.isNotNull(), F.col("weight")).otherwise(0))
