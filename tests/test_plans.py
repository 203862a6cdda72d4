"""The plans stay the ones that hold at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.adapters import Source
from changeloom.plans import personnel
from changeloom.queries import queries

FOLDER = "/root/testdata/sf0.001"
BUILT_BY_JOBS = ("stream_", "domain_", "full_reload", "append_with_defaults")


def plan(frame, mode="formatted"):
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), mode)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [n for n in queries() if not n.startswith(BUILT_BY_JOBS)])
def test_no_python_no_cross_join_no_expand(spark, no_broadcast, name):
    text = plan(queries()[name](spark, FOLDER))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Generate explode_outer"):
        assert operator not in text
    assert "SinglePartition" not in text or name in ("table_counts", "registry_replicate", "registry_from_ddl", "empty_bootstrap")


def test_filters_and_columns_reach_the_scan(spark, folder):
    source = Source(spark, FOLDER)
    source.employees().write.parquet(folder + "/e")
    source.attendance().withColumn("work_hours", F.lit(1.0)).write.parquet(folder + "/a")
    people, facts = spark.read.parquet(folder + "/e"), spark.read.parquet(folder + "/a")
    text = plan(personnel.late_ranking(facts, people))
    assert "IsNotNull(name), Not(EqualTo(name,))" in text
    assert "ReadSchema: struct<emp_id:bigint,name:string,department:string>" in text
    assert "ReadSchema: struct<emp_id:bigint,status:string,work_hours:double>" in text


def test_facts_are_summed_before_the_join(spark, no_broadcast):
    text = plan(queries()["late_ranking"](spark, FOLDER), "simple")
    # Partial sums of the facts, and the employees; the final grouping needs no third exchange.
    assert text.count("Exchange hashpartitioning") == 2


def test_row_level_functions_do_not_shuffle(spark):
    for name in ("attendance_analytics", "payroll_progressive", "payroll_flat", "attendance_reduced", "generic_projection"):
        assert "Exchange" not in plan(queries()[name](spark, FOLDER))


def test_top_k_does_not_sort_everything(spark):
    text = plan(queries()["top_products_5"](spark, FOLDER))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
