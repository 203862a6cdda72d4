"""Named views: what they read, how they are built and how a report orders them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, functions as F

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class View:
    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    """Called with one DataFrame per name in ``needs``."""
    order: tuple[str, ...] = ()
    """Columns of a report, largest first; ``+column`` sorts upwards. The tail makes the order total."""


def report(frame: DataFrame, view: View, limit: int | None = None) -> DataFrame:
    """The view as a person reads it: sorted, optionally only the first ``limit`` rows.

    Sorting stays out of the views themselves, so a view built on another does not pay for its order. With a
    limit Spark keeps the best rows of every task and merges those, without a full sort.
    """
    keys = [F.col(c[1:]).asc() if c.startswith("+") else F.col(c).desc() for c in view.order]
    ordered = frame.orderBy(*keys) if keys else frame
    return ordered if limit is None else ordered.limit(limit)


def build(views: Iterable[View], tables: Tables) -> dict[str, DataFrame]:
    """All views over ``tables``, those that read other views after them."""
    by_name = {view.name: view for view in views}
    made: dict[str, DataFrame] = dict(tables)
    order = _ordered(by_name)
    for name in order:
        view = by_name[name]
        made[name] = view.build(*[made[source] for source in view.needs])
    return {name: made[name] for name in order}


def register(spark: SparkSession, views: Iterable[View], tables: Tables, prefix: str = "") -> list[str]:
    """Make tables and views available to ``spark.sql``; returns the names in creation order."""
    views = list(views)
    built = build(views, tables)
    frames = {name: frame for name, frame in tables.items() if name not in built} | built
    for name, frame in frames.items():
        frame.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in frames]


def rebuild(spark: SparkSession, views: Iterable[View], tables: Tables, prefix: str = "") -> list[str]:
    """Drop everything, dependants first, and create it again over the present tables."""
    views = list(views)
    order = _ordered({view.name: view for view in views})
    for name in [*reversed(order), *(t for t in tables if t not in order)]:
        spark.catalog.dropTempView(prefix + name)
    return register(spark, views, tables, prefix)


def table_counts(frames: Tables) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _ordered(views: Mapping[str, View]) -> list[str]:
    graph = {name: [n for n in view.needs if n in views and n != name] for name, view in views.items()}
    return list(TopologicalSorter(graph).static_order())
