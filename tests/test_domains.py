"""Domains from their logs to their views."""

from __future__ import annotations

import pytest
import seeds
from pyspark.sql import functions as F

from changeloom import domains
from changeloom.registry import ADMIN, ADMIN_COLUMNS, Table
from changeloom.sources.changelog import RAW_LOG, file_log, snapshot_log

NOW = {"availableNow": True}


def run(spark, folder, domain, rows, prefix, **options):
    registries = [domain.copied] + ([domain.summed] if domain.summed else [])
    for registry in registries:
        for t in registry:
            log = snapshot_log(rows[t.name], t, registry.topic(t))
            log.coalesce(1).write.mode("append").json(folder + "/log", ignoreNullFields=False)

    def source(tables):
        return file_log(spark, folder + "/log").where(F.col("topic").isin([tables.topic(t) for t in tables]))

    for query in domain.start(source, folder + "/checkpoints", trigger=NOW, **options):
        query.awaitTermination()
    return domain.publish(spark, folder + "/checkpoints", prefix, options.get("group_size", 5))


def test_sales(spark, folder):
    names = run(spark, folder, domains.SALES, seeds.sales(spark), "dom_s_")
    assert "dom_s_customer_rfm" in names
    tiers = dict(spark.sql("SELECT rfm_tier, count(*) FROM dom_s_customer_rfm GROUP BY rfm_tier").collect())
    assert tiers == {"Loyal": 7, "At Risk": 2, "New Customer": 5, "Big Spender": 1}
    best = spark.sql("SELECT product_id FROM dom_s_top_products ORDER BY total_revenue DESC LIMIT 2").collect()
    assert [r.product_id for r in best] == [3, 1]


def test_personnel_basic(spark, folder):
    run(spark, folder, domains.PERSONNEL_BASIC, seeds.personnel(spark), "dom_b_", group_size=4)
    row = spark.sql("SELECT * FROM dom_b_payroll_summary WHERE department = 'Engineering'").first()
    assert (row.avg_base_salary, row.total_payroll) == (27800000, 140150000)


def test_personnel_reduced(spark, folder):
    run(spark, folder, domains.personnel_reduced(), seeds.personnel(spark), "dom_r_")
    assert spark.sql("SELECT sum(late_days) FROM dom_r_late_ranking").first()[0] == 50


def test_administration(spark, folder):
    kinds = {"string": "varchar(50)", "bigint": "datetime(6)", "int": "int", "double": "decimal(10,2)"}
    catalogue = [
        {"table_name": t.name, "column_name": f.name, "ordinal_position": n, "column_type": kinds[f.dataType.simpleString()]}
        for t in ADMIN
        for n, f in enumerate((t if t.name in ADMIN_COLUMNS else Table(t.name, t.key, f"{t.key[0]} string")).row_type.fields)
    ]
    rows = seeds.administration(spark)
    domain = domains.administration_domain(catalogue, *rows)
    run(spark, folder, domain, rows, "dom_a_", group_size=3)
    got = spark.sql("SELECT avg_days FROM dom_a_dossier_summary WHERE status = 'DA_DUYET'").first()[0]
    assert got == 3.88
    assert spark.sql("SELECT count(*) FROM dom_a_dn_inspection_stats").first()[0] == 0
    assert len(domains.administration_domain(catalogue).copied) == 85
    assert len(domains.administration_domain(catalogue, "alerts").views) == 1


def test_nothing_arrived_yet(spark, folder):
    names = domains.PERSONNEL.publish(spark, folder, "dom_n_")
    assert all(spark.table(name).count() == 0 for name in names)


def test_unreadable_messages_are_set_aside(spark, folder):
    demo = domains.DEMONSTRATION
    (table,) = demo.copied
    log = [(demo.copied.topic(table), 0, 0, '{"op": "c", "after": {"id": 1, "name": "a", "salary": 2.5}}'), (demo.copied.topic(table), 0, 1, "garbage")]
    spark.createDataFrame(log, RAW_LOG).write.json(folder + "/log")

    def source(tables):
        return file_log(spark, folder + "/log")

    with pytest.raises(ValueError):
        demo.start(source, folder + "/c", on_bad="skip")
    for query in demo.start(source, folder + "/c", trigger=NOW, on_bad="skip", dead_letters=folder + "/dead"):
        query.awaitTermination()
    assert [tuple(r) for r in demo.tables(spark, folder + "/c")["employees"].collect()] == [(1, "a", 2.5)]
    assert [r.value for r in spark.read.parquet(folder + "/dead/copied").collect()] == ["garbage"]
