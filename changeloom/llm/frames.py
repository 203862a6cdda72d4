"""Helpers shared by the operators: carried rows and columns that do not clash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: The columns of the documents table, which the stages of the pipeline hand on.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row(frame: DataFrame) -> Column:
    """All columns of a frame as one value, so that an operator's own names cannot clash with them."""
    return F.struct(*[F.col(f"`{name}`") for name in frame.columns])


def unpack(names: Sequence[str], added: Sequence[str], packed: str = "row") -> list[Column]:
    """The carried columns, without those whose name an operator's result takes, and then the result's."""
    taken = {name.lower() for name in added}
    kept = [F.col(f"{packed}.`{name}`").alias(name) for name in names if name.lower() not in taken]
    return [*kept, *[F.col(name) for name in added]]


def word_count(text: Column) -> Column:
    """Runs of anything but blanks, tabs and line ends; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.size(F.array_remove(parts, "")).cast("bigint")
