"""Row-level pipelines: the columns of a target row computed from a captured row. All are narrow: no shuffle.

Each pipeline is a list of columns, so that it fits a batch of rows as well as a batch of changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeloom.functions import attendance as att, payroll as pay


def attendance_columns(zone_offset_ms: int = att.ZONE_OFFSET_MS) -> list[Column]:
    """Hours, checked status, lateness, overtime and shift."""
    start, end = F.col("check_in"), F.col("check_out")
    hours = att.worked_hours(start, end)
    return [
        F.col("id"),
        F.col("emp_id"),
        start,
        end,
        hours.alias("work_hours"),
        att.presence_status(start, end, F.col("status")).alias("status"),
        att.is_late(start, zone_offset_ms).alias("is_late"),
        att.overtime_hours(hours).alias("overtime_hours"),
        att.shift_label(start, zone_offset_ms).alias("shift_label"),
    ]


def attendance_basic_columns() -> list[Column]:
    """Hours and checked status only."""
    return attendance_columns()[:6]


def attendance_reduced_columns(zone_offset_ms: int = att.ZONE_OFFSET_MS, unit: str = "ms") -> list[Column]:
    """Hours and lateness beside the status as recorded. Stamps in microseconds are brought to milliseconds."""
    start, end = (
        (F.expr(f"{c} div 1000") if unit == "us" else F.col(c)).alias(c) for c in ("check_in", "check_out")
    )
    return [
        F.col("id"),
        F.col("emp_id"),
        start,
        end,
        att.worked_hours(start, end).alias("work_hours"),
        F.col("status"),
        att.is_late(start, zone_offset_ms).alias("is_late"),
    ]


def payroll_columns() -> list[Column]:
    """Insurance, bracket tax and take-home pay beside the captured columns."""
    insurance = pay.insurance(F.col("base_salary"))
    tax = pay.progressive_tax(F.col("net_salary"))
    kept = ("id", "emp_id", "month", "base_salary", "deduction", "bonus", "net_salary")
    return [
        *[F.col(c) for c in kept],
        insurance.alias("insurance_amt"),
        tax.alias("tax_amount"),
        pay.take_home(F.col("net_salary"), insurance, tax).alias("take_home"),
    ]


def payroll_flat_columns() -> list[Column]:
    """Insurance, flat tax and take-home pay."""
    insurance = pay.insurance(F.col("base_salary"))
    tax = pay.flat_tax(F.col("net_salary"))
    return [
        *[F.col(c) for c in ("id", "emp_id", "month", "net_salary")],
        insurance.alias("insurance_amt"),
        tax.alias("tax_amount"),
        pay.take_home(F.col("net_salary"), insurance, tax).alias("take_home"),
    ]


def _of_employees(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("emp_id").isNotNull())


def attendance_analytics(rows: DataFrame, zone_offset_ms: int = att.ZONE_OFFSET_MS) -> DataFrame:
    return _of_employees(rows).select(*attendance_columns(zone_offset_ms))


def attendance_basic(rows: DataFrame) -> DataFrame:
    return _of_employees(rows).select(*attendance_basic_columns())


def attendance_reduced(rows: DataFrame, zone_offset_ms: int = att.ZONE_OFFSET_MS, unit: str = "ms") -> DataFrame:
    """No row is dropped."""
    return rows.select(*attendance_reduced_columns(zone_offset_ms, unit))


def payroll_progressive(rows: DataFrame) -> DataFrame:
    return _of_employees(rows).select(*payroll_columns())


def payroll_flat(rows: DataFrame) -> DataFrame:
    """No row is dropped."""
    return rows.select(*payroll_flat_columns())


def generic_projection(rows: DataFrame) -> DataFrame:
    """Id, name and creation time as text: the smallest common form of a captured table."""
    return rows.select("id", "name", F.col("created_at").cast("string").alias("created_at"))
