"""A whole domain in three calls: start its streams, read its tables, publish its views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changeloom.plans import administration, personnel, sales, views
from changeloom.registry import ADMIN, CRM, DEMO, HRM, HRM_BASIC, Registry, hrm_reduced
from changeloom.streaming.keyed_state import EVERY_MINUTE, current_tables, follow_groups, set_aside, states
from changeloom.streaming.state_totals import StateTotals, order_summary

LogSource = Callable[[Registry], DataFrame]
"""Opens the change log of some tables, e.g. ``lambda tables: kafka_log(spark, servers, tables)``."""


@dataclass(frozen=True)
class Domain:
    copied: Registry
    """Tables that are replicated row by row."""
    views: tuple[views.View, ...] = ()
    summed: Registry | None = None
    """The table whose totals are kept per group, if there is one."""
    totals: Mapping[str, str] = field(default_factory=dict)
    """Its ``group``, ``measure`` and ``latest`` columns."""
    summary: Callable[[DataFrame], DataFrame] = order_summary
    summary_name: str = "order_summary"

    def _kept(self, checkpoint: str, **options) -> StateTotals | None:
        return None if self.summed is None else StateTotals(self.summed, f"{checkpoint}/summed", **self.totals, **options)

    def start(
        self,
        source: LogSource,
        checkpoint: str,
        *,
        group_size: int = 5,
        complete: bool = False,
        trigger: Mapping[str, object] = EVERY_MINUTE,
        on_bad: str = "raise",
        dead_letters: str | None = None,
        **options,
    ) -> list[StreamingQuery]:
        """Start one query per group of copied tables, and those of the totals (see ``StateTotals.follow``; ``options`` go there).

        The tables are the state of these queries, below ``checkpoint``. With ``on_bad="skip"`` unreadable messages are kept in ``dead_letters``.
        """
        if (on_bad == "skip") != (dead_letters is not None):
            raise ValueError("dead_letters is where on_bad='skip' keeps unreadable messages; give both or neither")
        _, queries = follow_groups(source, self.copied, f"{checkpoint}/copied", group_size=group_size, trigger=trigger, on_bad=on_bad)
        kept = self._kept(checkpoint, **options)
        if kept is not None:
            queries += kept.follow(source(self.summed), complete=complete, trigger=trigger, on_bad=on_bad)
        if dead_letters is not None:
            for name, registry in (("copied", self.copied), ("summed", self.summed)):
                if registry is not None:
                    queries.append(set_aside(source(registry), registry, f"{dead_letters}/{name}", f"{checkpoint}/bad_{name}", trigger=trigger))
        return queries

    def tables(self, spark: SparkSession, checkpoint: str, group_size: int = 5) -> dict[str, DataFrame]:
        """The present rows of every table; tables that nothing has arrived for are empty."""
        found = current_tables(spark, states(self.copied, f"{checkpoint}/copied", group_size))
        kept = self._kept(checkpoint)
        return found if kept is None else found | {self.summary_name: self.summary(kept.current(spark))}

    def publish(self, spark: SparkSession, checkpoint: str, prefix: str = "", group_size: int = 5) -> list[str]:
        """Make tables and views available to ``spark.sql`` as of now; call it again for newer rows."""
        return views.rebuild(spark, self.views, self.tables(spark, checkpoint, group_size), prefix)


PERSONNEL = Domain(HRM, personnel.VIEWS)
PERSONNEL_BASIC = Domain(HRM_BASIC, personnel.BASIC_VIEWS)
SALES = Domain(
    CRM.select("customers", "products", "order_items"),
    tuple(v for v in sales.VIEWS if v.name != "order_summary"),
    CRM.select("orders"),
    {"group": "cus_id", "measure": "amount", "latest": "order_at"},
)
DEMONSTRATION = Domain(DEMO)


def personnel_reduced(source: str = "mysql") -> Domain:
    """The reduced personnel set; leave requests are captured but not kept."""
    return Domain(hrm_reduced(source).select("employees", "attendance", "payroll"), personnel.REDUCED_VIEWS)


def administration_domain(catalogue, *patterns: str) -> Domain:
    """All administration tables, or those matching ``patterns``, with the columns of a column catalogue."""
    tables = ADMIN.select(*patterns) if patterns else ADMIN
    names = {t.name for t in tables}
    return Domain(tables.resolve(catalogue), tuple(v for v in administration.VIEWS if names.issuperset(v.needs)))
