"""Captured tables, topics, groups and column catalogues."""

from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from changeloom.registry import ADMIN, CRM, DEMO, HRM, HRM_BASIC, Registry, Table, column_type, hrm_reduced, with_times
from changeloom.operators.changes import current_rows
from changeloom.sources.changelog import changes, snapshot_log

COLUMN_TYPES = {
    "bigint": ("bigint", None),
    "int": ("int", None),
    "int(11) unsigned": ("int", None),
    "tinyint(1)": ("int", None),
    "varchar(255)": ("string", None),
    "text": ("string", None),
    "longtext": ("string", None),
    "longblob": ("string", None),
    "json": ("string", None),
    "decimal(12,2)": ("double", None),
    "numeric(15, 2)": ("double", None),
    "double": ("double", None),
    "boolean": ("boolean", None),
    "date": ("int", "days"),
    "datetime": ("bigint", "ms"),
    "datetime(6)": ("bigint", "us"),
    "timestamp": ("bigint", "us"),
    "timestamp(3)": ("bigint", "ms"),
    "int2": ("int", None),
    "int8": ("bigint", None),
    "float8": ("double", None),
}


@pytest.mark.parametrize("source", COLUMN_TYPES)
def test_column_types(source):
    assert column_type(source) == COLUMN_TYPES[source]


def test_exact_decimals():
    assert column_type("DECIMAL(12,2)", exact=True) == ("decimal(12,2)", None)


def test_topics_and_targets():
    assert HRM.topic("employees") == "hrm.hrm.employees"
    assert CRM.topic(CRM["products"]) == "crm.crm.products"
    assert DEMO.topic("employees") == "hrm_demo.public.employees"
    assert hrm_reduced("postgres").topic("payroll") == "hrm_pg.public.payroll"
    assert hrm_reduced("mysql").topic("payroll") == "hrm_mysql.hrm.payroll"
    assert HRM["attendance"].sink == "attendance_analytics"
    assert hrm_reduced()["payroll"].sink == "payroll_analytics"
    assert ADMIN["files"].sink == "sys_files"


def test_administration_tables():
    assert len(ADMIN) == 85 == len({t.name for t in ADMIN})
    assert sum(t.key == ("id",) for t in ADMIN) == 72
    assert [len(g) for g in ADMIN.groups(5)] == [5] * 17
    assert [t.name for t in ADMIN.select("dn_*")][:2] == ["dn_enterprise", "dn_inspection_dossier"]
    assert {t.name for t in CRM} == {"customers", "orders", "products", "order_items", "customer_events"}
    assert len(HRM_BASIC) == 4


def test_selection_must_match():
    assert len(HRM.select("*")) == 4 and [t.name for t in HRM.select("payroll", "employees")] == ["employees", "payroll"]
    with pytest.raises(KeyError):
        HRM.select("employees", "nothing*")
    with pytest.raises(KeyError):
        HRM["nothing"]


def catalogue(**tables):
    return [
        {"table_name": t, "column_name": c, "ordinal_position": n, "column_type": kind}
        for t, columns in tables.items()
        for n, (c, kind) in enumerate(columns)
    ]


def test_resolve_fills_in_columns(spark):
    columns = [("id", "bigint"), ("type", "varchar(20)"), ("created_at", "datetime(6)"), ("day", "date")]
    made = Registry("p", "s", (Table("t", ("id",)),)).resolve(reversed(catalogue(t=columns)))
    t = made["t"]
    assert t.row_type.simpleString() == "struct<id:bigint,type:string,created_at:bigint,day:int>"
    rows = spark.createDataFrame([(1, "x", 1_775_037_600_000_000, 20_544)], t.row_type)
    row = with_times(rows, t).first()
    assert str(row.day_ts) == "2026-04-01" and row.created_at_ts is not None


def test_resolve_fails_loudly():
    registry = Registry("p", "s", (Table("t", ("id",)),))
    with pytest.raises(ValueError, match="not in the column catalogue"):
        registry.resolve(catalogue(other=[("id", "int")]))
    with pytest.raises(ValueError, match="no key column"):
        registry.resolve(catalogue(t=[("name", "text")]))
    with pytest.raises(ValueError, match="has no columns"):
        registry["t"].row_type


def test_every_administration_table_replicates(spark):
    """Each table gets its key and some columns of every kind from a catalogue, and arrives complete."""
    extra = [("note", "text"), ("amount", "decimal(10,2)"), ("at", "datetime(6)"), ("flag", "tinyint(1)")]
    made = ADMIN.resolve(catalogue(**{t.name: [(t.key[0], "varchar(50)"), *extra] for t in ADMIN}))
    data = [("a", "n", 1.5, 1, 1), ("b", None, None, None, 0), (None, "no key", 0.0, 0, 0)]
    for group in made.groups(5):
        log = reduce(DataFrame.unionByName, [snapshot_log(spark.createDataFrame(data, t.row_type), t, made.topic(t)) for t in group])
        arrived = [
            t.project(current_rows(changes(log.where(f"topic = '{made.topic(t)}'"), t), t.key, t.row_type))
            .toDF("key", "note", "amount", "at", "flag").withColumn("tbl", F.lit(t.name))
            for t in group
        ]
        got = {tuple(r) for r in reduce(DataFrame.unionByName, arrived).collect()}
        assert got == {(*row, t.name) for t in group for row in data[:2]}
    assert all(t.row_type.fieldNames()[0] == t.key[0] for t in made)


def test_postgres_stamps_are_microseconds(spark):
    rows = [(1, 1, 1_775_037_600_000_000, 1_775_041_200_000_000, "x")]
    t = hrm_reduced("postgres")["attendance"]
    row = t.project(spark.createDataFrame(rows, t.row_type)).first()
    assert (row.check_in, row.work_hours) == (1_775_037_600_000, 1.0)
    m = hrm_reduced("mysql")["attendance"]
    millis = [(1, 1, 1_775_037_600_000, 1_775_041_200_000, "x")]
    assert m.project(spark.createDataFrame(millis, m.row_type)).first() == row
