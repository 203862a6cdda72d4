"""Views kept up to date by what changed, without reading what did not.

A signed frame has a ``weight`` beside its columns: +1 for a row that comes, -1 for one that goes (``changes.weighted`` makes them out of a
change log). Joins and sums are linear in the weights, so the change of a view follows from the changes of its tables:

* join: the rows that A's change meets in B, those that B's change meets in A, and those of both changes together;
* grouped sums and counts: the same sums over the signed rows, added to the stored row of each group they touch.

A view over a view goes on with the signed rows that the first one gives: the old row of a touched group out, the new one in.

Write a change to files before it is used: it is read several times, and Spark then knows its size, so that a small one is broadcast to where the
tables are scanned and no row of them is moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WEIGHT, ROWS = "weight", "row_count"


def net(signed: DataFrame) -> DataFrame:
    """Rows that come and go in the same change cancelled out; each task cancels its own first."""
    columns = [c for c in signed.columns if c != WEIGHT]
    return signed.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


def join_delta(left: DataFrame, d_left: DataFrame, right: DataFrame, d_right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The signed change of ``left`` joined with ``right``, both as they were before theirs.

    Only rows of ``left`` and ``right`` whose keys are in the other side's change come out of their scans; the changes are small beside them
    and are broadcast if Spark finds them small enough.
    """
    one = F.lit(1).cast("bigint").alias(WEIGHT)
    whole_left, whole_right = left.select("*", one), right.select("*", one)

    def pair(a: DataFrame, b: DataFrame) -> DataFrame:
        joined = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in on])
        kept = [F.col(f"a.`{c}`") for c in left.columns] + [F.col(f"b.`{c}`") for c in right.columns if c not in on]
        return joined.select(*kept, (F.col(f"a.{WEIGHT}") * F.col(f"b.{WEIGHT}")).alias(WEIGHT))

    return reduce(DataFrame.unionByName, [pair(d_left, whole_right), pair(whole_left, d_right), pair(d_left, d_right)])


def sums_delta(signed: DataFrame, group: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """What signed rows add to the sums of each group, and to its number of rows."""
    added = [F.sum(F.col(WEIGHT) * value).cast("bigint").alias(name) for name, value in sums.items()]
    return signed.groupBy(*group).agg(*added, F.sum(WEIGHT).cast("bigint").alias(ROWS))


def sums_of(rows: DataFrame, group: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """The same over all rows: the stored form of a view, to begin with."""
    return sums_delta(rows.withColumn(WEIGHT, F.lit(1).cast("bigint")), group, sums)


def view_delta(view: DataFrame, delta: DataFrame, group: Sequence[str]) -> DataFrame:
    """The signed rows by which a stored view changes: -1 for the old row of a touched group, +1 for the new one.

    ``view`` has the columns of ``delta``; one row is there for each group. Only touched groups come out of the view's scan, groups without rows
    go. Groups are compared null-safe.
    """
    sums = [c for c in view.columns if c not in group]
    same = [F.col(f"v.{g}").eqNullSafe(F.col(f"d.{g}")) for g in group]
    touched = view.alias("v").join(delta.select(*group).alias("d"), same, "left_semi")
    both = delta.alias("d").join(touched.alias("v"), same, "left")
    old = F.struct(*[F.col(f"v.{c}").alias(c) for c in sums])
    new = F.struct(*[(F.coalesce(F.col(f"v.{c}"), F.lit(0)) + F.col(f"d.{c}")).cast("bigint").alias(c) for c in sums])
    images = F.array(F.struct(F.lit(-1).cast("bigint").alias(WEIGHT), old.alias("r")), F.struct(F.lit(1).cast("bigint").alias(WEIGHT), new.alias("r")))
    rows = both.select(*[F.col(f"d.{g}").alias(g) for g in group], F.explode(images).alias("i"))
    return rows.where(F.col(f"i.r.{ROWS}") != 0).select(*group, *[F.col(f"i.r.{c}").alias(c) for c in sums], F.col(f"i.{WEIGHT}").alias(WEIGHT))


def applied(rows: DataFrame, signed: DataFrame, key: Sequence[str]) -> DataFrame:
    """A table or view of one row per key after a signed change that holds, for each key in it, at most one row to come."""
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key]
    kept = rows.alias("r").join(signed.select(*key).distinct().alias("s"), same, "left_anti")
    return kept.unionByName(signed.where(F.col(WEIGHT) > 0).select(*rows.columns))
