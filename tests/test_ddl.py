"""Registries out of the text that makes a source's tables."""

from __future__ import annotations

import pytest

from changeloom.sources import ddl

MYSQL = """
-- people; not a table
DROP TABLE IF EXISTS employees;
CREATE TABLE IF NOT EXISTS `hr`.`employees` (
  `emp_id` BIGINT UNSIGNED NOT NULL AUTO_INCREMENT COMMENT 'the key; of a, b (c)',
  name VARCHAR(100) CHARACTER SET utf8 DEFAULT 'CREATE TABLE x (y INT)', /* , z INT */
  salary DECIMAL(12, 2),
  hired DATE, seen DATETIME(6) DEFAULT CURRENT_TIMESTAMP(6), `key` TINYINT(1), # flags
  note LONGTEXT,
  PRIMARY KEY (`emp_id`), UNIQUE KEY u (name, hired), KEY `k` (`salary`),
  CONSTRAINT f FOREIGN KEY (hired) REFERENCES days(day), CHECK (salary > 0)
) ENGINE=InnoDB DEFAULT CHARSET=utf8;
create table limits (limit_type varchar(20), target varchar(20) not null, max_value double precision, constraint pk primary key (target, limit_type));
"""
POSTGRES = 'CREATE TABLE public."orders" (id serial PRIMARY KEY, at timestamp with time zone NOT NULL, made timestamp(3) without time zone, ok boolean, total numeric(10,2));'


@pytest.fixture()
def texts(spark):
    return spark.createDataFrame([(MYSQL,), (POSTGRES,), (None,), ("",), ("SELECT 1; INSERT INTO t VALUES (1)",), ("CREATE TABLE none_yet",)], "ddl string")


def test_columns(texts):
    found = {}
    for r in sorted(ddl.columns_of(texts).collect(), key=lambda r: (r.table_name, r.ordinal_position)):
        found.setdefault(r.table_name, []).append((r.column_name, r.column_type, r.key_position))
    assert found == {
        "employees": [
            ("emp_id", "bigint", 1), ("name", "varchar(100)", None), ("salary", "decimal(12,2)", None), ("hired", "date", None),
            ("seen", "datetime(6)", None), ("key", "tinyint(1)", None), ("note", "longtext", None),
        ],
        "limits": [("limit_type", "varchar(20)", 2), ("target", "varchar(20)", 1), ("max_value", "double precision", None)],
        "orders": [("id", "serial", 1), ("at", "timestamp with time zone", None), ("made", "timestamp(3)", None), ("ok", "boolean", None), ("total", "numeric(10,2)", None)],
    }


def test_registry(texts):
    registry = ddl.registry(texts, "p", "s")
    assert [(t.name, t.key) for t in registry] == [("employees", ("emp_id",)), ("limits", ("target", "limit_type")), ("orders", ("id",))]
    people = registry["employees"]
    assert people.row_type.simpleString() == "struct<emp_id:bigint,name:string,salary:double,hired:int,seen:bigint,key:int,note:string>"
    assert people.units == {"hired": "days", "seen": "us"} and registry["orders"].units == {"at": "us", "made": "ms"}
    assert ddl.registry(texts, "p", "s", exact=True)["orders"].row_type["total"].dataType.simpleString() == "decimal(10,2)"


def test_no_key_and_no_tables(spark):
    one = spark.createDataFrame([("CREATE TABLE t (a INT, b TEXT)",)], "ddl string")
    assert ddl.registry(one, "p", "s")["t"].key == ("a",)
    assert len(ddl.registry(one.limit(0), "p", "s")) == 0 and ddl.types_of(ddl.columns_of(one.limit(0))).count() == 0


def test_nothing_of_it_runs_in_python(texts):
    plan = ddl.columns_of(texts)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "BatchEval" not in plan and "Exchange" not in plan
