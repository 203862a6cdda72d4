"""Labels derived from totals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
VIP_FROM = 50_000_000
HIGH_VALUE_FROM = 10_000_000
LOYAL_FROM = 5_000_000
CRITICAL_FROM = 4
WARNING_FROM = 2


def value_tier(total: Column, vip: int = VIP_FROM, high: int = HIGH_VALUE_FROM) -> Column:
    return F.when(total >= vip, "VIP").when(total >= high, "HIGH_VALUE").otherwise("NORMAL")


def rfm_tier(frequency: Column, monetary: Column, big: int = HIGH_VALUE_FROM, loyal: int = LOYAL_FROM) -> Column:
    """Ordered ladder: the first rule that holds gives the label."""
    return (
        F.when((frequency >= 3) & (monetary >= big), "Champions")
        .when((frequency >= 2) & (monetary >= loyal), "Loyal")
        .when((frequency == 1) & (monetary >= big), "Big Spender")
        .when(frequency == 1, "New Customer")
        .otherwise("At Risk")
    )


def discipline_tier(late_days: Column, critical: int = CRITICAL_FROM, warning: int = WARNING_FROM) -> Column:
    return F.when(late_days >= critical, "CRITICAL").when(late_days >= warning, "WARNING").otherwise("GOOD")
