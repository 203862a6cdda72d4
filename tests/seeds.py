"""Small seed tables with known results.

Fixed values: rows that the expected results of the views were computed from, one row per line. Names are made up,
as no result depends on them. Times are UTC wall clock.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from changeloom.registry import ADMIN, CUSTOMERS, EMPLOYEES, LEAVE_REQUESTS, ORDER_ITEMS, ORDERS, PAYROLL, PRODUCTS

# emp_id, department
EMPLOYEE_ROWS = """
1 Engineering
2 Marketing
3 Engineering
4 HR
5 Engineering
6 HR
7 Engineering
8 Marketing
9 Finance
10 Engineering
"""

# emp_id, day, check-in, check-out, status
ATTENDANCE_ROWS = """
1 2026-04-01 08:00 17:00 ON_TIME
2 2026-04-01 09:10 18:00 LATE
3 2026-04-01 08:05 17:30 ON_TIME
4 2026-04-01 08:20 17:00 ON_TIME
5 2026-04-01 09:30 18:10 LATE
6 2026-04-01 08:00 17:00 ON_TIME
7 2026-04-01 08:15 16:30 EARLY_LEAVE
8 2026-04-01 09:00 18:00 LATE
9 2026-04-01 08:00 17:00 ON_TIME
10 2026-04-01 08:40 17:30 ON_TIME
1 2026-04-02 08:10 17:10 ON_TIME
2 2026-04-02 09:20 18:00 LATE
3 2026-04-02 08:00 17:00 ON_TIME
4 2026-04-02 08:25 17:00 ON_TIME
5 2026-04-02 09:10 18:00 LATE
6 2026-04-02 08:05 17:00 ON_TIME
7 2026-04-02 08:30 16:45 EARLY_LEAVE
8 2026-04-02 09:15 18:20 LATE
9 2026-04-02 08:00 17:00 ON_TIME
10 2026-04-02 08:50 17:40 ON_TIME
1 2026-04-03 08:00 17:00 ON_TIME
2 2026-04-03 09:30 18:10 LATE
3 2026-04-03 08:10 17:20 ON_TIME
4 2026-04-03 08:00 17:00 ON_TIME
5 2026-04-03 09:40 18:30 LATE
6 2026-04-03 08:00 17:00 ON_TIME
7 2026-04-03 08:20 16:40 EARLY_LEAVE
8 2026-04-03 09:25 18:15 LATE
9 2026-04-03 08:05 17:05 ON_TIME
10 2026-04-03 08:45 17:30 ON_TIME
1 2026-04-04 08:00 17:00 ON_TIME
2 2026-04-04 09:15 18:00 LATE
3 2026-04-04 08:00 17:00 ON_TIME
4 2026-04-04 08:30 17:00 ON_TIME
5 2026-04-04 09:20 18:10 LATE
6 2026-04-04 08:05 17:00 ON_TIME
7 2026-04-04 08:25 16:50 EARLY_LEAVE
8 2026-04-04 09:35 18:30 LATE
9 2026-04-04 08:00 17:00 ON_TIME
10 2026-04-04 08:55 17:45 ON_TIME
1 2026-04-05 08:10 17:10 ON_TIME
2 2026-04-05 09:25 18:10 LATE
3 2026-04-05 08:05 17:00 ON_TIME
4 2026-04-05 08:15 17:00 ON_TIME
5 2026-04-05 09:30 18:20 LATE
6 2026-04-05 08:00 17:00 ON_TIME
7 2026-04-05 08:20 16:40 EARLY_LEAVE
8 2026-04-05 09:40 18:30 LATE
9 2026-04-05 08:00 17:00 ON_TIME
10 2026-04-05 08:50 17:30 ON_TIME
"""

# emp_id, type, days, status
LEAVE_ROWS = """
1 annual 5 pending
2 sick 2 approved
3 sick 2 approved
4 annual 3 approved
5 sick 1 approved
6 sick 1 approved
7 annual 2 pending
8 unpaid 1 rejected
9 annual 3 approved
10 unpaid 2 pending
"""

# emp_id, base salary, deduction, bonus, net salary
PAYROLL_ROWS = """
1 25000000 0 500000 25500000
2 20000000 250000 0 19750000
3 28000000 0 500000 28500000
4 18000000 0 500000 18500000
5 30000000 250000 0 29750000
6 22000000 0 500000 22500000
7 27000000 100000 0 26900000
8 21000000 250000 0 20750000
9 26000000 0 500000 26500000
10 29000000 0 500000 29500000
"""

# cus_id, region, segment, channel
CUSTOMER_ROWS = """
1 Bac Premium web
2 Nam Standard app
3 Trung Premium store
4 Nam Budget web
5 Bac Premium app
6 Trung Standard web
7 Bac Standard store
8 Nam Budget app
9 Trung Premium web
10 Bac Standard web
11 Nam Premium app
12 Bac Budget store
13 Trung Standard web
14 Nam Premium app
15 Bac Budget web
"""

# product_id, category, price
PRODUCT_ROWS = """
1 Electronics 30000000
2 Electronics 25000000
3 Electronics 45000000
4 Fashion 350000
5 Fashion 890000
6 Fashion 2500000
7 Home 1200000
8 Home 3500000
9 Food 250000
10 Food 450000
11 Electronics 8500000
12 Fashion 1800000
13 Home 5000000
14 Food 320000
15 Electronics 20000000
"""

# cus_id, amount, day, time
ORDER_ROWS = """
1 30350000 2026-04-01 10:00
1 9390000 2026-04-02 11:30
2 1200000 2026-04-01 14:00
2 3500000 2026-04-03 16:00
3 45000000 2026-04-01 08:30
3 8850000 2026-04-04 10:00
4 800000 2026-04-02 13:00
4 700000 2026-04-05 15:00
5 38500000 2026-04-01 09:00
5 8500000 2026-04-03 11:00
6 6700000 2026-04-02 10:00
7 4300000 2026-04-01 12:00
7 2000000 2026-04-04 14:00
8 900000 2026-04-03 09:00
9 53500000 2026-04-02 11:00
9 8500000 2026-04-04 16:00
10 31800000 2026-04-01 10:30
10 2000000 2026-04-05 13:00
11 30350000 2026-04-01 09:00
11 450000 2026-04-03 14:00
12 350000 2026-04-02 11:00
13 3500000 2026-04-01 10:00
14 55000000 2026-04-02 09:00
15 250000 2026-04-03 15:00
"""

# order_id, product_id, quantity, unit price
ITEM_ROWS = """
1 1 1 30000000
1 10 1 350000
2 11 1 8500000
2 9 1 250000
2 14 2 320000
3 4 2 350000
3 9 1 250000
4 8 1 3500000
5 3 1 45000000
6 11 1 8500000
6 10 1 350000
7 5 1 800000
8 9 2 250000
8 14 1 200000
9 1 1 30000000
9 11 1 8500000
10 11 1 8500000
11 13 1 5000000
11 8 1 1700000
12 7 2 1200000
12 14 2 320000
13 12 1 2000000
14 7 1 1200000
15 3 1 45000000
15 15 1 8500000
16 11 1 8500000
17 15 1 20000000
17 1 1 11800000
18 8 1 2000000
19 1 1 30000000
19 10 1 350000
20 10 1 450000
21 4 1 350000
22 13 1 3500000
23 3 1 45000000
23 1 1 10000000
24 9 1 250000
"""

# dossier_id, tax_code, type, submitted, processed, status
DOSSIER_ROWS = """
DOS-001 0101234567 NOP_LAN_DAU 2026-04-02T08:00:00 NULL DANG_XU_LY
DOS-002 0209876543 NOP_LAN_DAU 2026-04-01T09:00:00 2026-04-05T14:00:00 DA_DUYET
DOS-003 0312345678 NOP_LAN_DAU 2026-04-02T10:00:00 NULL CHO_BO_SUNG
DOS-004 0498765432 NOP_LAN_DAU 2026-04-03T08:30:00 NULL DANG_XU_LY
DOS-005 0511223344 NOP_LAN_DAU 2026-04-03T11:00:00 2026-04-08T10:00:00 TU_CHOI
DOS-006 0644332211 NOP_LAN_DAU 2026-04-04T09:00:00 2026-04-07T16:00:00 DA_DUYET
DOS-007 0755443322 BO_SUNG 2026-04-04T14:00:00 NULL DANG_XU_LY
DOS-008 0866554433 NOP_LAN_DAU 2026-04-05T10:00:00 NULL TAO_MOI
DOS-009 0977665544 NOP_LAN_DAU 2026-04-06T08:00:00 2026-04-10T11:00:00 DA_DUYET
DOS-010 1088776655 NOP_LAN_DAU NULL NULL TAO_MOI
"""

# alert_id, type, severity, status
ALERT_ROWS = """
ALT-001 DOSSIER_OVERDUE WARNING NEW
ALT-002 REGISTRATION_FAIL CRITICAL ACKNOWLEDGED
ALT-003 CERT_EXPIRING WARNING NEW
ALT-004 API_ERROR CRITICAL RESOLVED
ALT-005 DOSSIER_OVERDUE WARNING NEW
ALT-006 SYNC_FAILED CRITICAL RESOLVED
ALT-007 INSPECTION_RESULT INFO NEW
ALT-008 DOSSIER_OVERDUE CRITICAL NEW
"""

# id, amend_version, enterprise, procedure, status
REGISTRATION_ROWS = """
REG-001 0 0101234567 BCT-NK-001 APPROVED
REG-002 0 0312345678 BYT-DP-001 PROCESSING
REG-003 0 0498765432 BYT-TP-001 APPROVED
REG-004 1 0511223344 BNN-TV-001 REJECTED
REG-005 0 0209876543 BTC-HQ-001 APPROVED
REG-006 0 0644332211 BCT-NK-002 PROCESSING
REG-007 0 0755443322 BCT-NK-001 APPROVED
REG-008 0 0866554433 BNN-TY-001 PROCESSING
REG-009 0 0977665544 BTC-HQ-001 APPROVED
REG-010 0 1088776655 BCT-NK-001 RECEIVED
"""

# id, amount, status
INVOICE_ROWS = """
INV-001 1500000 PAID
INV-002 2300000 PENDING
INV-003 800000 PAID
INV-004 3200000 PAID
INV-005 1100000 PENDING
INV-006 4500000 OVERDUE
INV-007 2700000 PAID
INV-008 1900000 PENDING
"""


def _rows(text: str) -> list[list[str]]:
    return [line.split() for line in text.strip().splitlines()]


def epoch(day: str, clock: str, scale: int = 1000) -> int:
    moment = datetime.fromisoformat(f"{day}T{clock}").replace(tzinfo=timezone.utc)
    return int(moment.timestamp()) * scale


def _micros(stamp: str) -> int | None:
    return None if stamp == "NULL" else epoch(*stamp.split("T"), scale=1_000_000)


def personnel(spark: SparkSession) -> dict[str, DataFrame]:
    employees = [(int(e), f"Employee {e}", d, 0.0) for e, d in _rows(EMPLOYEE_ROWS)]
    attendance = [
        (n, int(e), epoch(day, start), epoch(day, end), status)
        for n, (e, day, start, end, status) in enumerate(_rows(ATTENDANCE_ROWS), 1)
    ]
    leave = [
        (n, int(e), kind, 0, 0, int(days), status, "")
        for n, (e, kind, days, status) in enumerate(_rows(LEAVE_ROWS), 1)
    ]
    payroll = [
        (n, int(e), "2026-04", float(base), float(minus), float(bonus), float(net))
        for n, (e, base, minus, bonus, net) in enumerate(_rows(PAYROLL_ROWS), 1)
    ]
    return {
        "employees": spark.createDataFrame(employees, EMPLOYEES.columns),
        "attendance": spark.createDataFrame(
            attendance, "id bigint, emp_id bigint, check_in bigint, check_out bigint, status string"
        ),
        "leave_requests": spark.createDataFrame(leave, LEAVE_REQUESTS.columns),
        "payroll": spark.createDataFrame(payroll, PAYROLL.columns),
    }


def sales(spark: SparkSession) -> dict[str, DataFrame]:
    customers = [
        (int(c), f"Customer {c}", f"c{c}@example.com", 0, region, segment, channel)
        for c, region, segment, channel in _rows(CUSTOMER_ROWS)
    ]
    orders = [
        (n, int(c), int(amount), epoch(day, clock)) for n, (c, amount, day, clock) in enumerate(_rows(ORDER_ROWS), 1)
    ]
    products = [(int(p), f"Product {p}", category, int(price)) for p, category, price in _rows(PRODUCT_ROWS)]
    items = [(n, *map(int, row)) for n, row in enumerate(_rows(ITEM_ROWS), 1)]
    return {
        "customers": spark.createDataFrame(customers, CUSTOMERS.columns),
        "orders": spark.createDataFrame(orders, ORDERS.columns),
        "products": spark.createDataFrame(products, PRODUCTS.columns),
        "order_items": spark.createDataFrame(items, ORDER_ITEMS.columns),
    }


def administration(spark: SparkSession) -> dict[str, DataFrame]:
    dossiers = [
        (d, tax, kind, _micros(sent), _micros(done), status, 0)
        for d, tax, kind, sent, done, status in _rows(DOSSIER_ROWS)
    ]
    registrations = [
        (r, int(version), enterprise, code, status, f"Procedure {code}")
        for r, version, enterprise, code, status in _rows(REGISTRATION_ROWS)
    ]
    rows = {
        "dossiers": dossiers,
        "alerts": [tuple(row) for row in _rows(ALERT_ROWS)],
        "registrations": registrations,
        "invoices": [(i, float(amount), status) for i, amount, status in _rows(INVOICE_ROWS)],
        "enterprise": [(row[1], f"Enterprise {row[1]}") for row in dossiers],
        "dn_inspection_result": [],
    }
    return {name: spark.createDataFrame(data, ADMIN[name].row_type) for name, data in rows.items()}
