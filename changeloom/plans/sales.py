"""Sales views over customers, orders, products and order items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeloom.functions.tiers import HIGH_VALUE_FROM, LOYAL_FROM, VIP_FROM, rfm_tier, value_tier
from changeloom.plans.views import View


def order_summary(orders: DataFrame, vip: int = VIP_FROM, high: int = HIGH_VALUE_FROM) -> DataFrame:
    """Totals, value tier and time of the last order per customer. Map-side partial sums absorb hot customers."""
    known = orders.where(F.col("cus_id").isNotNull() & F.col("amount").isNotNull())
    totals = known.groupBy("cus_id").agg(
        F.sum(F.col("amount").cast("bigint")).alias("total_amount"),
        F.count(F.lit(1)).alias("order_count"),
        F.max("order_at").alias("last_order_at"),
    )
    return totals.select(
        "cus_id",
        "total_amount",
        "order_count",
        value_tier(F.col("total_amount"), vip, high).alias("status"),
        "last_order_at",
    )


def order_summary_max(versions: DataFrame) -> DataFrame:
    """Largest value of each column over all versions of a summary row, the status compared as text."""
    known = versions.where(F.col("cus_id").isNotNull() & F.col("total_amount").isNotNull())
    return known.groupBy("cus_id").agg(
        *[F.max(c).alias(c) for c in ("total_amount", "order_count", "status", "last_order_at")]
    )


def order_summary_latest(versions: DataFrame) -> DataFrame:
    """The largest total, count and time of all versions, with the status of the largest total: right while totals only grow."""
    known = versions.where(F.col("cus_id").isNotNull() & F.col("total_amount").isNotNull())
    return known.groupBy("cus_id").agg(
        F.max("total_amount").alias("total_amount"),
        F.max("order_count").alias("order_count"),
        F.max_by("status", "total_amount").alias("status"),
        F.max("last_order_at").alias("last_order_at"),
    )


def order_summary_newest(versions: DataFrame, version: str) -> DataFrame:
    """The newest version of every summary row as a whole, whether its total has grown or fallen."""
    known = versions.where(F.col("cus_id").isNotNull())
    kept = ["total_amount", "order_count", "status", "last_order_at"]
    newest = known.groupBy("cus_id").agg(F.max_by(F.struct(*kept), version).alias("newest"))
    return newest.select("cus_id", *[F.col(f"newest.{c}") for c in kept])


def regional_summary(customers: DataFrame, summary: DataFrame) -> DataFrame:
    """Customers, revenue and orders per region. Grouping by region and customer first turns the distinct count
    into a plain one and reuses the join's partitioning."""
    placed = customers.where(F.col("region").isNotNull()).select("cus_id", "region")
    per_customer = (
        placed.join(summary.select("cus_id", "total_amount", "order_count"), "cus_id")
        .groupBy("cus_id", "region")
        .agg(F.sum("total_amount").alias("revenue"), F.sum("order_count").alias("orders"))
    )
    return per_customer.groupBy("region").agg(
        F.count("cus_id").alias("customer_count"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("orders").alias("total_orders"),
    )


def _line_value() -> Column:
    return F.col("quantity").cast("bigint") * F.col("unit_price").cast("bigint")


def category_revenue(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, orders and quantity per category.

    The single distinct count makes Spark aggregate by category and order first, so the few, large categories are
    spread over the orders before they are brought together.
    """
    sold = order_items.where(F.col("product_id").isNotNull()).select(
        "product_id", "order_id", F.col("quantity").cast("bigint").alias("quantity"), _line_value().alias("value")
    )
    return (
        sold.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("value").alias("total_revenue"),
            F.countDistinct("order_id").alias("order_count"),
            F.sum("quantity").alias("total_qty"),
        )
    )


def top_products(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, quantity and orders per product, summed before the join with the products."""
    sold = (
        order_items.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.sum(_line_value()).alias("revenue"),
            F.sum(F.col("quantity").cast("bigint")).alias("qty"),
            F.countDistinct("order_id").alias("orders"),
        )
    )
    return (
        sold.join(products.select("product_id", "name", "category", "price"), "product_id")
        .groupBy("product_id", "name", "category", "price")
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("qty").alias("total_qty"),
            F.max("orders").alias("order_count"),
        )
    )


def customer_rfm(
    customers: DataFrame, summary: DataFrame, big: int = HIGH_VALUE_FROM, loyal: int = LOYAL_FROM
) -> DataFrame:
    """Every customer with orders, labelled by how often and how much they buy."""
    known = customers.select("cus_id", "name", "region", "segment", "registered_channel")
    frequency, monetary = F.col("order_count"), F.col("total_amount")
    return known.join(summary, "cus_id").select(
        "cus_id",
        "name",
        "region",
        "segment",
        "registered_channel",
        frequency.alias("frequency"),
        monetary.alias("monetary"),
        "status",
        rfm_tier(frequency, monetary, big, loyal).alias("rfm_tier"),
    )


VIEWS = (
    View("order_summary", ("orders",), order_summary, ("+cus_id",)),
    View("regional_summary", ("customers", "order_summary"), regional_summary, ("total_revenue", "+region")),
    View("category_revenue", ("order_items", "products"), category_revenue, ("total_revenue", "+category")),
    View("top_products", ("order_items", "products"), top_products, ("total_revenue", "+product_id")),
    View("customer_rfm", ("customers", "order_summary"), customer_rfm, ("monetary", "+cus_id")),
)
