"""Administration views over dossiers, alerts, registrations, invoices, enterprises and inspection results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeloom.functions.times import days_between
from changeloom.plans.views import View


def dossier_summary(dossiers: DataFrame, unit: str = "us") -> DataFrame:
    """Dossiers by status and type with their mean processing time in days; open dossiers do not count in it."""
    known = dossiers.where(F.col("dossier_id").isNotNull() & F.col("submitted_at").isNotNull())
    # Whole units are summed, so that the mean does not depend on the order of the rows; as decimals, as a bigint holds
    # the microseconds of some ten thousand long dossiers only.
    spent = F.col("processed_at").cast("decimal(20,0)") - F.col("submitted_at").cast("decimal(20,0)")
    mean = F.sum(spent).cast("double") / F.count(spent)
    return known.groupBy("status", "procedure_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("is_deleted") == 0, 1).otherwise(0)).alias("active"),
        F.round(days_between(F.lit(0), mean, unit), 2).alias("avg_days"),
    )


def alert_dashboard(alerts: DataFrame) -> DataFrame:
    return (
        alerts.where(F.col("alert_id").isNotNull())
        .groupBy("severity", "status", "alert_type")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.when(F.col("status") != "RESOLVED", 1).otherwise(0)).alias("active_count"),
        )
    )


def registration_stats(registrations: DataFrame) -> DataFrame:
    return (
        registrations.where(F.col("id").isNotNull())
        .groupBy("procedure_code", "procedure_name", "status")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.when(F.col("amend_version") > 0, 1).otherwise(0)).alias("amended"),
        )
    )


def invoice_revenue(invoices: DataFrame) -> DataFrame:
    return (
        invoices.where(F.col("id").isNotNull())
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("invoice_count"),
            F.round(F.sum("amount"), 0).alias("total_amount"),
            F.round(F.avg("amount"), 0).alias("avg_amount"),
        )
    )


def enterprise_activity(enterprise: DataFrame, dossiers: DataFrame, registrations: DataFrame) -> DataFrame:
    """Dossiers and registrations of every enterprise.

    Joining both first would pair each dossier with each registration of its enterprise. Both are counted on their
    own key instead, so every join meets at most one row per enterprise.
    """
    filed = dossiers.groupBy("tax_code").agg(F.countDistinct("dossier_id").alias("dossiers"))
    registered = registrations.groupBy(F.col("enterprise_id").alias("tax_code")).agg(
        F.countDistinct("id").alias("registrations")
    )
    return (
        enterprise.select("tax_code", "enterprise_name")
        .join(filed, "tax_code", "left")
        .join(registered, "tax_code", "left")
        .groupBy("tax_code", "enterprise_name")
        .agg(
            F.coalesce(F.max("dossiers"), F.lit(0).cast("bigint")).alias("dossier_count"),
            F.coalesce(F.max("registrations"), F.lit(0).cast("bigint")).alias("registration_count"),
        )
    )


def dn_inspection_stats(dn_inspection_result: DataFrame) -> DataFrame:
    return (
        dn_inspection_result.where(F.col("id").isNotNull())
        .groupBy("result_content")
        .agg(F.count(F.lit(1)).alias("total"), F.countDistinct("inspection_dossier_id").alias("unique_dossiers"))
    )


VIEWS = (
    View("dossier_summary", ("dossiers",), dossier_summary, ("total", "+status", "+procedure_type")),
    View("alert_dashboard", ("alerts",), alert_dashboard, ("total", "+severity", "+status", "+alert_type")),
    View(
        "registration_stats",
        ("registrations",),
        registration_stats,
        ("total", "+procedure_code", "+procedure_name", "+status"),
    ),
    View("invoice_revenue", ("invoices",), invoice_revenue, ("total_amount", "+status")),
    View(
        "enterprise_activity",
        ("enterprise", "dossiers", "registrations"),
        enterprise_activity,
        ("dossier_count", "+tax_code"),
    ),
    View("dn_inspection_stats", ("dn_inspection_result",), dn_inspection_stats, ("total", "+result_content")),
)
