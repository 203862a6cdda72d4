"""Views over the seed tables against independently computed results."""

from __future__ import annotations

import pytest
import seeds

from changeloom.plans import administration, personnel, sales, transforms, views


def rows(frame, *columns):
    return {tuple(r) for r in (frame.select(*columns) if columns else frame).collect()}


@pytest.fixture(scope="module")
def hrm(spark):
    tables = seeds.personnel(spark)
    tables["attendance"] = transforms.attendance_analytics(tables["attendance"])
    tables["payroll_in"], tables["payroll"] = tables["payroll"], transforms.payroll_progressive(tables["payroll"])
    return tables


@pytest.fixture(scope="module")
def hrm_views(hrm):
    return views.build(personnel.VIEWS, hrm)


@pytest.fixture(scope="module")
def crm_views(spark):
    return views.build(sales.VIEWS, seeds.sales(spark))


@pytest.fixture(scope="module")
def admin_views(spark):
    return views.build(administration.VIEWS, seeds.administration(spark))


def test_department_stats(hrm_views):
    assert rows(hrm_views["department_stats"]) == {
        ("Marketing", 2, 10, 8.83, 10, 0, 0),
        ("Engineering", 5, 25, 8.80, 5, 15, 5),
        ("HR", 2, 10, 8.83, 0, 10, 0),
        ("Finance", 1, 5, 9.00, 0, 5, 0),
    }


def test_late_ranking(hrm_views):
    got = rows(
        hrm_views["late_ranking"], "emp_id", "total_days", "late_days", "early_leave_days", "avg_work_hours", "discipline_tier"
    )
    hours = {1: 9.00, 2: 8.73, 3: 9.10, 4: 8.70, 5: 8.80, 6: 8.97, 7: 8.32, 8: 8.93, 9: 9.00, 10: 8.78}
    assert got == {
        (e, 5, 5 if e in (2, 5, 8) else 0, 5 if e == 7 else 0, h, "CRITICAL" if e in (2, 5, 8) else "GOOD")
        for e, h in hours.items()
    }


OVERTIME = {3: 5.50, 1: 5.00, 9: 5.00, 6: 4.83, 8: 4.67, 5: 4.00, 10: 3.92, 2: 3.67, 4: 3.50, 7: 1.58}


def test_overtime_report(hrm_views):
    got = rows(
        hrm_views["overtime_report"], "emp_id", "total_ot_hours", "ot_days", "late_by_flag", "morning_days", "afternoon_days"
    )
    assert got == {(e, h, 5, 5, 0, 5) for e, h in OVERTIME.items()}


def test_overtime_report_by_local_clock(spark, hrm):
    attendance = transforms.attendance_analytics(seeds.personnel(spark)["attendance"], zone_offset_ms=0)
    report = personnel.overtime_report(attendance, hrm["employees"])
    late = {8: 4, 5: 5, 2: 5}
    got = rows(report, "emp_id", "total_ot_hours", "late_by_flag", "morning_days", "afternoon_days")
    assert got == {(e, h, late.get(e, 0), 5, 0) for e, h in OVERTIME.items()}


def test_leave_analysis(hrm_views):
    got = rows(
        hrm_views["leave_analysis"],
        "emp_id",
        "total_requests",
        "approved_days",
        "sick_requests",
        "annual_requests",
        "pending_requests",
    )
    assert got == {
        (4, 1, 3, 0, 1, 0),
        (9, 1, 3, 0, 1, 0),
        (2, 1, 2, 1, 0, 0),
        (3, 1, 2, 1, 0, 0),
        (5, 1, 1, 1, 0, 0),
        (6, 1, 1, 1, 0, 0),
        (1, 1, 0, 0, 1, 1),
        (7, 1, 0, 0, 1, 1),
        (8, 1, 0, 0, 0, 0),
        (10, 1, 0, 0, 0, 1),
    }


def test_payroll(hrm):
    got = {
        (r.id, round(r.insurance_amt), round(r.tax_amount), round(r.take_home)) for r in hrm["payroll"].collect()
    }
    assert got == {
        (1, 2625000, 1425000, 21450000),
        (2, 2100000, 625000, 17025000),
        (3, 2940000, 1875000, 23685000),
        (4, 1890000, 500000, 16110000),
        (5, 3150000, 2100000, 24500000),
        (6, 2310000, 975000, 19215000),
        (7, 2835000, 1635000, 22430000),
        (8, 2205000, 725000, 17820000),
        (9, 2730000, 1575000, 22195000),
        (10, 3045000, 2050000, 24405000),
    }


def test_payroll_summary(hrm, hrm_views):
    assert rows(hrm_views["payroll_summary"]) == {
        ("Engineering", 27800000, 2919000, 1817000, 28030000, 23294000, 116470000),
        ("HR", 20000000, 2100000, 737500, 20500000, 17662500, 35325000),
        ("Marketing", 20500000, 2152500, 675000, 20250000, 17422500, 34845000),
        ("Finance", 26000000, 2730000, 1575000, 26500000, 22195000, 22195000),
    }
    assert rows(personnel.payroll_summary_gross(hrm["payroll_in"], hrm["employees"])) == {
        ("Engineering", 27800000, 70000, 300000, 28030000, 140150000),
        ("HR", 20000000, 0, 500000, 20500000, 41000000),
        ("Marketing", 20500000, 250000, 0, 20250000, 40500000),
        ("Finance", 26000000, 0, 500000, 26500000, 26500000),
    }


def test_guard_leaves_out_people_without_a_name(spark, hrm):
    nameless = spark.createDataFrame([(2, "", "Marketing", 0.0), (3, None, "Engineering", 0.0)], hrm["employees"].schema)
    people = hrm["employees"].where("emp_id NOT IN (2, 3)").unionByName(nameless)
    guarded = personnel.department_stats(hrm["attendance"], people)
    free = personnel.department_stats(hrm["attendance"], people, guard=False)
    assert {r.department: r.employee_count for r in guarded.collect()} == {
        "Marketing": 1,
        "Engineering": 4,
        "HR": 2,
        "Finance": 1,
    }
    assert {r.department: r.employee_count for r in free.collect()}["Engineering"] == 5
    assert personnel.attendance_summary(hrm["attendance"], people).count() == 40


def test_views_survive_groups_without_values(spark):
    tables = seeds.personnel(spark)
    open_days = tables["attendance"].withColumn("check_out", tables["attendance"].check_out * None)
    stats = personnel.department_stats(transforms.attendance_analytics(open_days), tables["employees"])
    assert {r.avg_work_hours for r in stats.collect()} == {None}


def test_order_summary(crm_views):
    assert rows(crm_views["order_summary"]) == {
        (1, 39740000, 2, "HIGH_VALUE", 1775129400000),
        (2, 4700000, 2, "NORMAL", 1775232000000),
        (3, 53850000, 2, "VIP", 1775296800000),
        (4, 1500000, 2, "NORMAL", 1775401200000),
        (5, 47000000, 2, "HIGH_VALUE", 1775214000000),
        (6, 6700000, 1, "NORMAL", 1775124000000),
        (7, 6300000, 2, "NORMAL", 1775311200000),
        (8, 900000, 1, "NORMAL", 1775206800000),
        (9, 62000000, 2, "VIP", 1775318400000),
        (10, 33800000, 2, "HIGH_VALUE", 1775394000000),
        (11, 30800000, 2, "HIGH_VALUE", 1775224800000),
        (12, 350000, 1, "NORMAL", 1775127600000),
        (13, 3500000, 1, "NORMAL", 1775037600000),
        (14, 55000000, 1, "VIP", 1775120400000),
        (15, 250000, 1, "NORMAL", 1775228400000),
    }


def test_regions_and_categories(crm_views):
    assert rows(crm_views["regional_summary"]) == {
        ("Bac", 6, 127440000, 10),
        ("Trung", 4, 126050000, 6),
        ("Nam", 5, 92900000, 8),
    }
    assert rows(crm_views["category_revenue"]) == {
        ("Electronics", 317800000, 11, 15),
        ("Home", 19300000, 6, 8),
        ("Food", 4230000, 9, 14),
        ("Fashion", 3850000, 4, 5),
    }


def test_top_products(crm_views):
    view = next(v for v in sales.VIEWS if v.name == "top_products")
    ranked = [
        (r.product_id, r.total_revenue, r.total_qty, r.order_count)
        for r in views.report(crm_views["top_products"], view).collect()
    ]
    assert ranked == [
        (3, 135000000, 3, 3),
        (1, 111800000, 5, 5),
        (11, 42500000, 5, 5),
        (15, 28500000, 2, 2),
        (13, 8500000, 2, 2),
        (8, 7200000, 3, 3),
        (7, 3600000, 3, 2),
        (12, 2000000, 1, 1),
        (10, 1500000, 4, 4),
        (14, 1480000, 5, 3),
        (9, 1250000, 5, 4),
        (4, 1050000, 3, 2),
        (5, 800000, 1, 1),
    ]
    assert [r.product_id for r in views.report(crm_views["top_products"], view, 5).collect()] == [3, 1, 11, 15, 13]


def test_customer_rfm(crm_views):
    tiers = {r.cus_id: r.rfm_tier for r in crm_views["customer_rfm"].collect()}
    expected = dict.fromkeys((1, 3, 5, 7, 9, 10, 11), "Loyal") | dict.fromkeys((2, 4), "At Risk")
    expected |= dict.fromkeys((6, 8, 12, 13, 15), "New Customer") | {14: "Big Spender"}
    assert tiers == expected
    view = next(v for v in sales.VIEWS if v.name == "customer_rfm")
    money = [r.monetary for r in views.report(crm_views["customer_rfm"], view).collect()]
    assert money == sorted(money, reverse=True)


def test_versions_by_text_and_by_amount(spark):
    versions = spark.createDataFrame(
        [(1, 5, 1, "NORMAL", 10), (1, 20, 2, "HIGH_VALUE", 20), (None, 1, 1, "VIP", 1)],
        "cus_id bigint, total_amount bigint, order_count bigint, status string, last_order_at bigint",
    )
    assert rows(sales.order_summary_max(versions)) == {(1, 20, 2, "NORMAL", 20)}
    assert rows(sales.order_summary_latest(versions)) == {(1, 20, 2, "HIGH_VALUE", 20)}


def test_dossier_summary(spark, admin_views):
    assert rows(admin_views["dossier_summary"]) == {
        ("DA_DUYET", "NOP_LAN_DAU", 3, 3, 3.88),
        ("DANG_XU_LY", "NOP_LAN_DAU", 2, 2, None),
        ("CHO_BO_SUNG", "NOP_LAN_DAU", 1, 1, None),
        ("DANG_XU_LY", "BO_SUNG", 1, 1, None),
        ("TAO_MOI", "NOP_LAN_DAU", 1, 1, None),
        ("TU_CHOI", "NOP_LAN_DAU", 1, 1, 4.96),
    }
    as_millis = administration.dossier_summary(seeds.administration(spark)["dossiers"], unit="ms")
    assert {r.avg_days for r in as_millis.collect()} == {3875.0, None, 4958.33}


def test_dossier_days_beyond_a_bigint_of_microseconds(spark):
    year = 365 * 86_400_000_000
    each = spark.range(4).selectExpr("concat('D', id) AS dossier_id", f"-{100_000 * year}L AS submitted_at", f"{100_000 * year}L AS processed_at", "'A' AS status", "'B' AS procedure_type", "0 AS is_deleted")
    assert rows(administration.dossier_summary(each)) == {("A", "B", 4, 4, 73_000_000.0)}


def test_alerts_and_registrations(admin_views):
    assert rows(admin_views["alert_dashboard"]) == {
        ("WARNING", "NEW", "DOSSIER_OVERDUE", 2, 2),
        ("WARNING", "NEW", "CERT_EXPIRING", 1, 1),
        ("CRITICAL", "ACKNOWLEDGED", "REGISTRATION_FAIL", 1, 1),
        ("CRITICAL", "NEW", "DOSSIER_OVERDUE", 1, 1),
        ("CRITICAL", "RESOLVED", "API_ERROR", 1, 0),
        ("CRITICAL", "RESOLVED", "SYNC_FAILED", 1, 0),
        ("INFO", "NEW", "INSPECTION_RESULT", 1, 1),
    }
    assert rows(admin_views["registration_stats"], "procedure_code", "status", "total", "amended") == {
        ("BCT-NK-001", "APPROVED", 2, 0),
        ("BTC-HQ-001", "APPROVED", 2, 0),
        ("BCT-NK-001", "RECEIVED", 1, 0),
        ("BCT-NK-002", "PROCESSING", 1, 0),
        ("BNN-TV-001", "REJECTED", 1, 1),
        ("BNN-TY-001", "PROCESSING", 1, 0),
        ("BYT-DP-001", "PROCESSING", 1, 0),
        ("BYT-TP-001", "APPROVED", 1, 0),
    }


def test_invoices_enterprises_inspections(admin_views):
    assert rows(admin_views["invoice_revenue"]) == {
        ("PAID", 4, 8200000, 2050000),
        ("PENDING", 3, 5300000, 1766667),
        ("OVERDUE", 1, 4500000, 4500000),
    }
    activity = admin_views["enterprise_activity"].collect()
    assert len(activity) == 10 and {(r.dossier_count, r.registration_count) for r in activity} == {(1, 1)}
    assert admin_views["dn_inspection_stats"].count() == 0


def test_enterprise_without_anything(spark):
    tables = seeds.administration(spark)
    lone = spark.createDataFrame([("x", "X")], tables["enterprise"].schema)
    got = administration.enterprise_activity(lone, tables["dossiers"], tables["registrations"])
    assert rows(got) == {("x", "X", 0, 0)}


def test_register_rebuild_and_counts(spark):
    tables = seeds.sales(spark)
    names = views.register(spark, sales.VIEWS, tables, prefix="t_")
    assert names.index("t_order_summary") < names.index("t_customer_rfm")
    assert spark.sql("SELECT count(*) FROM t_customer_rfm").first()[0] == 15
    tables["orders"] = tables["orders"].where("cus_id = 1")
    views.rebuild(spark, sales.VIEWS, tables, prefix="t_")
    assert spark.sql("SELECT count(*) FROM t_customer_rfm").first()[0] == 1
    counts = views.table_counts({"customers": tables["customers"], "orders": tables["orders"]})
    assert rows(counts) == {("customers", 15), ("orders", 2)}
