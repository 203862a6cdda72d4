"""Personnel views over employees, attendance, leave requests and payroll.

A fact table is summed per employee before it meets the employees. The partial sums of every task are what is
shuffled, so an employee with a third of all rows costs no more than one with ten, and the join handles one row
per employee. The second aggregation groups by the join key and more, so it needs no further exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeloom.functions.tiers import discipline_tier
from changeloom.plans.views import View


def _named(employees: DataFrame) -> DataFrame:
    return employees.where(F.col("name").isNotNull() & (F.col("name") != ""))


def _count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _mean(name: str, digits: int) -> Column:
    """Rounded mean from the partial sum and count of a column; NULL when no row has a value."""
    return F.round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")), digits)


def _parts(*names: str) -> list[Column]:
    """Partial sum and non-null count of each column."""
    return [c for n in names for c in (F.sum(n).alias(f"{n}_sum"), F.count(n).alias(f"{n}_n"))]


def _per_employee(facts: DataFrame, employees: DataFrame, *parts: Column) -> DataFrame:
    """Partial aggregates of each employee's facts, joined with the employee."""
    sums = facts.where(F.col("emp_id").isNotNull()).groupBy("emp_id").agg(*parts)
    return sums.join(employees.select("emp_id", "name", "department"), "emp_id")


def attendance_summary(attendance: DataFrame, employees: DataFrame, guard: bool = True) -> DataFrame:
    """Every attendance row with its employee. Row-level, so a hot employee is left to the skew join of AQE."""
    people = _named(employees) if guard else employees
    facts = attendance.where(F.col("emp_id").isNotNull())
    return facts.join(people.select("emp_id", "name", "department"), "emp_id").select(
        "emp_id", "name", "department", "status", "work_hours", "check_in", "check_out"
    )


def department_stats(attendance: DataFrame, employees: DataFrame, guard: bool = True) -> DataFrame:
    people = _named(employees) if guard else employees
    status = F.col("status")
    per_employee = _per_employee(
        attendance,
        people,
        F.count("id").alias("sessions"),
        *_parts("work_hours"),
        _count_where(status == "LATE").alias("late"),
        _count_where(status == "ON_TIME").alias("on_time"),
        _count_where(status == "EARLY_LEAVE").alias("early"),
    )
    # One row per department and employee, so that the distinct count becomes a plain one.
    distinct = per_employee.groupBy("emp_id", "department").agg(
        *[F.sum(c).alias(c) for c in ("sessions", "work_hours_sum", "work_hours_n", "late", "on_time", "early")]
    )
    return distinct.groupBy("department").agg(
        F.count("emp_id").alias("employee_count"),
        F.sum("sessions").alias("total_sessions"),
        _mean("work_hours", 2).alias("avg_work_hours"),
        F.sum("late").alias("late_count"),
        F.sum("on_time").alias("on_time_count"),
        F.sum("early").alias("early_leave_count"),
    )


def late_ranking(attendance: DataFrame, employees: DataFrame, guard: bool = True) -> DataFrame:
    people = _named(employees) if guard else employees
    status = F.col("status")
    per_employee = _per_employee(
        attendance,
        people,
        F.count(F.lit(1)).alias("days"),
        _count_where(status == "LATE").alias("late"),
        _count_where(status == "EARLY_LEAVE").alias("early"),
        *_parts("work_hours"),
    )
    return (
        per_employee.groupBy("emp_id", "name", "department")
        .agg(
            F.sum("days").alias("total_days"),
            F.sum("late").alias("late_days"),
            F.sum("early").alias("early_leave_days"),
            _mean("work_hours", 2).alias("avg_work_hours"),
        )
        .withColumn("discipline_tier", discipline_tier(F.col("late_days")))
    )


def leave_analysis(leave_requests: DataFrame, employees: DataFrame, guard: bool = True) -> DataFrame:
    people = _named(employees) if guard else employees
    per_employee = _per_employee(
        leave_requests,
        people,
        F.count("id").alias("requests"),
        F.sum(F.when(F.col("status") == "approved", F.col("days")).otherwise(0)).alias("approved"),
        _count_where(F.col("leave_type") == "sick").alias("sick"),
        _count_where(F.col("leave_type") == "annual").alias("annual"),
        _count_where(F.col("status") == "pending").alias("pending"),
    )
    return per_employee.groupBy("emp_id", "name", "department").agg(
        F.sum("requests").alias("total_requests"),
        F.sum("approved").alias("approved_days"),
        F.sum("sick").alias("sick_requests"),
        F.sum("annual").alias("annual_requests"),
        F.sum("pending").alias("pending_requests"),
    )


def payroll_summary(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    measures = ("base_salary", "insurance_amt", "tax_amount", "net_salary", "take_home")
    per_employee = _per_employee(payroll, _named(employees), *_parts(*measures))
    return per_employee.groupBy("department").agg(
        _mean("base_salary", 0).alias("avg_base_salary"),
        _mean("insurance_amt", 0).alias("avg_insurance"),
        _mean("tax_amount", 0).alias("avg_tax"),
        _mean("net_salary", 0).alias("avg_net_salary"),
        _mean("take_home", 0).alias("avg_take_home"),
        F.round(F.sum("take_home_sum"), 0).alias("total_take_home"),
    )


def payroll_summary_gross(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Deductions and bonuses instead of insurance and tax; employees without a name count too."""
    measures = ("base_salary", "deduction", "bonus", "net_salary")
    per_employee = _per_employee(payroll, employees, *_parts(*measures))
    return per_employee.groupBy("department").agg(
        _mean("base_salary", 0).alias("avg_base_salary"),
        _mean("deduction", 0).alias("avg_deduction"),
        _mean("bonus", 0).alias("avg_bonus"),
        _mean("net_salary", 0).alias("avg_net_salary"),
        F.round(F.sum("net_salary_sum"), 0).alias("total_payroll"),
    )


def payroll_average_income(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    per_employee = _per_employee(payroll, employees, *_parts("take_home"))
    return per_employee.groupBy("department").agg(_mean("take_home", 0).alias("avg_income"))


def overtime_report(attendance: DataFrame, employees: DataFrame) -> DataFrame:
    per_employee = _per_employee(
        attendance,
        _named(employees),
        F.sum("overtime_hours").alias("hours"),
        F.count(F.when(F.col("overtime_hours") > 0, 1)).alias("days"),
        F.count(F.when(F.col("is_late"), 1)).alias("late"),
        F.count(F.when(F.col("shift_label") == "MORNING", 1)).alias("morning"),
        F.count(F.when(F.col("shift_label") == "AFTERNOON", 1)).alias("afternoon"),
    )
    return per_employee.groupBy("emp_id", "name", "department").agg(
        F.round(F.sum("hours"), 2).alias("total_ot_hours"),
        F.sum("days").alias("ot_days"),
        F.sum("late").alias("late_by_flag"),
        F.sum("morning").alias("morning_days"),
        F.sum("afternoon").alias("afternoon_days"),
    )


def late_ranking_by_flag(attendance: DataFrame, employees: DataFrame) -> DataFrame:
    """Late days per name and department; people who share both are counted together."""
    per_employee = _per_employee(attendance.where("is_late"), employees, F.count(F.lit(1)).alias("late"))
    return per_employee.groupBy("name", "department").agg(F.sum("late").alias("late_days"))


def _unguarded(view):
    return lambda facts, employees: view(facts, employees, guard=False)


VIEWS = (
    View("attendance_summary", ("attendance", "employees"), attendance_summary),
    View("department_stats", ("attendance", "employees"), department_stats, ("late_count", "+department")),
    View("late_ranking", ("attendance", "employees"), late_ranking, ("late_days", "+emp_id")),
    View("leave_analysis", ("leave_requests", "employees"), leave_analysis, ("approved_days", "+emp_id")),
    View("payroll_summary", ("payroll", "employees"), payroll_summary, ("total_take_home", "+department")),
    View("overtime_report", ("attendance", "employees"), overtime_report, ("total_ot_hours", "+emp_id")),
)
"""Over the full derived tables, leaving out employees without a name."""

BASIC_VIEWS = (
    View("attendance_summary", ("attendance", "employees"), _unguarded(attendance_summary)),
    View("department_stats", ("attendance", "employees"), _unguarded(department_stats), ("late_count", "+department")),
    View("late_ranking", ("attendance", "employees"), _unguarded(late_ranking), ("late_days", "+emp_id")),
    View("leave_analysis", ("leave_requests", "employees"), _unguarded(leave_analysis), ("approved_days", "+emp_id")),
    View("payroll_summary", ("payroll", "employees"), payroll_summary_gross, ("total_payroll", "+department")),
)
"""Over the plain copies, all employees."""

REDUCED_VIEWS = (
    View("late_ranking", ("attendance", "employees"), late_ranking_by_flag, ("late_days", "+name", "+department")),
    View("payroll_summary", ("payroll", "employees"), payroll_average_income, ("avg_income", "+department")),
)
