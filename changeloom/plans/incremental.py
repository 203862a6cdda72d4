"""Sales views by their changes (see ``changeloom.operators.deltas``).

``keep`` may write the sums of a change, one row for each touched group, and read them back: they are used twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from changeloom.operators.deltas import ROWS, join_delta, sums_delta, sums_of, view_delta


Keep = Callable[[DataFrame], DataFrame]


def _counted(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("cus_id").isNotNull() & F.col("amount").isNotNull())


def summary_of(orders: DataFrame) -> DataFrame:
    """Totals per customer in their stored form; the number of rows is that of the orders."""
    return sums_of(_counted(orders), ["cus_id"], {"total_amount": F.col("amount")})


def summary_delta(summary: DataFrame, orders: DataFrame, keep: Keep = lambda frame: frame) -> DataFrame:
    """The change of ``summary`` by signed orders."""
    return view_delta(summary, keep(sums_delta(_counted(orders), ["cus_id"], {"total_amount": F.col("amount")})), ["cus_id"])


def _revenue() -> dict[str, Column]:
    return {"total_revenue": F.col("total_amount"), "total_orders": F.col("orders")}


def _orders(summary: DataFrame) -> DataFrame:
    return summary.withColumnRenamed(ROWS, "orders")


def regions_of(customers: DataFrame, summary: DataFrame) -> DataFrame:
    """Revenue, orders and customers (the number of rows) per region in their stored form."""
    placed = customers.where(F.col("region").isNotNull()).join(_orders(summary), "cus_id")
    return sums_of(placed, ["region"], _revenue())


def regions_delta(regions: DataFrame, customers: DataFrame, d_customers: DataFrame, summary: DataFrame, d_summary: DataFrame, keep: Keep = lambda frame: frame) -> DataFrame:
    """The change of ``regions`` by those of its two tables, both given as they were before."""
    known, d_known = (frame.where(F.col("region").isNotNull()) for frame in (customers, d_customers))
    change = join_delta(known, d_known, _orders(summary), _orders(d_summary), ["cus_id"])
    return view_delta(regions, keep(sums_delta(change, ["region"], _revenue())), ["region"])
