"""One callable per operator, pipeline and view, over the tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField

from changeloom import domains, files
from changeloom.adapters import (
    HIGH,
    LOYAL,
    USER_STATE,
    USERS,
    VIP,
    Source,
    captured,
    generic_registry,
    micros,
    millis,
)
from changeloom.operators import deltas, distinct, generations, skipping
from changeloom.operators.changes import current_rows, weighted, weighted_count, weighted_sum
from changeloom.operators.colocated import Colocated
from changeloom.operators.upsert import append, reload, upsert, upsert_any
from changeloom.plans import administration as adm, incremental, personnel, sales, transforms, views
from changeloom.registry import ADMIN, CRM, DEMO, HRM, HRM_BASIC, Registry, Table, hrm_reduced, with_times
from changeloom.session import dropping_shuffles, work_path
from changeloom.sources.changelog import (
    bad_messages,
    changes,
    envelope,
    file_log,
    in_generation,
    message,
    snapshot_log,
    variant_field,
    versioned_log,
)
from changeloom.sources import ddl, snapshot as snapshots
from changeloom.sources.tables import scan
from changeloom.streaming import state_totals
from changeloom.streaming.fan_out import FanOut
from changeloom.streaming.keyed_state import KeyedState, current_tables, follow_groups

NOW = {"availableNow": True}
CHECKSUM = (1 << 61) - 1


# Tables as the views expect them


def _attendance(s: Source) -> DataFrame:
    return transforms.attendance_analytics(s.attendance())


def _payroll(s: Source) -> DataFrame:
    return transforms.payroll_progressive(s.payroll())


def _summary(s: Source) -> DataFrame:
    return sales.order_summary(s.orders(), VIP, HIGH)


def _done_summary(s: Source) -> DataFrame:
    done = s.read("orders").where("o_orderstatus <> 'O'").select(
        F.col("o_custkey").alias("cus_id"),
        F.floor("o_totalprice").cast("bigint").alias("amount"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("order_at"),
    )
    return sales.order_summary(done, VIP, HIGH)


def _summary_versions(s: Source) -> DataFrame:
    """Two versions of every summary: before and after its open orders."""
    return _done_summary(s).unionByName(_summary(s))


def order_summary_newest(s: Source) -> DataFrame:
    """Summaries whose open orders are cancelled in the end, so that totals fall."""
    first, second = (frame.withColumn("version", F.lit(n)) for n, frame in enumerate([_summary(s), _done_summary(s)]))
    return sales.order_summary_newest(first.unionByName(second), "version")


# Change logs


def _store_log(s: Source, log: DataFrame, slices: int = 6) -> tuple[str, int]:
    """Keep a log as files in offset order; returns the folder and the number of files that make half of it."""
    path = work_path(s.spark, "log")
    parts = max(slices, int(s.spark.conf.get("spark.sql.shuffle.partitions")))
    log.repartitionByRange(parts, "offset", F.xxhash64("value")).write.option("compression", "zstd").parquet(path)
    count = sum(name.endswith(".parquet") for name in files.children(s.spark, path))
    return path, -(-count // 2)


def _stream(s: Source, log: DataFrame) -> Callable[[], DataFrame]:
    path, half = _store_log(s, log)
    return lambda: file_log(s.spark, path, format="parquet", max_files=half)


def _kept(s: Source, registry: Registry, log: DataFrame) -> KeyedState:
    """All tables of a log, by one query that has come to its end."""
    kept = KeyedState(registry, work_path(s.spark, "checkpoint"))
    kept.follow(_stream(s, log)(), trigger=NOW).awaitTermination()
    return kept


def cdc_unwrap(s: Source) -> DataFrame:
    decoded = changes(s.order_log(CRM), CRM["orders"])
    images = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in ("cus_id", "amount")]
    return decoded.select("id", "op", "ts_ms", "offset", *images)


def cdc_dead_letters(s: Source) -> DataFrame:
    """The order log with the messages that move urgent and high priority orders cut short: these are the ones set aside."""
    log = s.order_log(CRM)
    cut = F.when(F.col("offset") % 4 == 1, F.expr("left(value, length(value) - 2)")).otherwise(F.col("value"))
    return bad_messages(log.withColumn("value", cut), CRM["orders"]).select("partition", "offset")


def cdc_snapshot_then_changes(s: Source) -> DataFrame:
    """Orders as a snapshot, then what happened to them: later changes win, and rows without any come from the snapshot alone."""
    table = CRM["orders"]
    snapshot = snapshot_log(s.spread(s.orders()), table, CRM.topic(table))
    created = F.col("offset") % 4 == 0
    log = snapshot.unionByName(s.order_log(CRM).where(~created))
    return current_rows(changes(log, table), table.key, table.row_type)


CHUNKS = 8


def cdc_chunked_snapshot(s: Source) -> DataFrame:
    """Orders whose snapshot is taken in eight chunks while their log goes on.

    The capture begins at a quarter of the log. Each chunk is read later than the one before, the table being what the log has made of it by
    then, and its marks lie around that moment. Keys are dealt out to the chunks, so each one meets rows that are finished, being
    changed, and not there yet.
    """
    table = CRM["orders"]
    end = s.read("orders").agg(F.max("o_orderkey") * 4 + 3).head()[0] or 0
    step = end // (CHUNKS + 4)
    marks = s.spark.range(CHUNKS).selectExpr("id AS chunk", f"(id + 3) * {step} AS low", f"(id + 5) * {step} AS high")
    decoded = changes(s.order_log(CRM), table)
    chunk = F.pmod("id", F.lit(CHUNKS))
    moment = (chunk + 4) * step
    present = current_rows(decoded.where(F.col("offset") <= moment), table.key, table.row_type).withColumn("chunk", chunk)
    captured_log = s.order_log(CRM).where(F.col("offset") > 3 * step)
    snapshot = snapshots.settled(present, marks, changes(captured_log, table), table, CRM.topic(table))
    return current_rows(changes(snapshot.unionByName(captured_log), table), table.key, table.row_type)


def cdc_current_state(s: Source) -> DataFrame:
    return current_rows(changes(s.event_log(), USER_STATE), USER_STATE.key, USER_STATE.row_type)


def cdc_weighted_totals(s: Source) -> DataFrame:
    table = CRM["orders"]
    rows = weighted(changes(s.order_log(CRM, complete=True), table), table.row_type)
    sums = rows.groupBy("cus_id").agg(
        weighted_sum(F.col("amount")).alias("total_amount"), weighted_count().alias("order_count")
    )
    return sums.where("order_count <> 0")


def stream_replicate(s: Source) -> DataFrame:
    """The last event of every user, each batch written once for all targets."""
    kept = FanOut(USERS, work_path(s.spark, "targets"))
    kept.follow(_stream(s, s.event_log())(), work_path(s.spark, "checkpoint"), trigger=NOW).awaitTermination()
    return kept.current(s.spark, "user_state")


def _hrm_log(s: Source, registry: Registry) -> DataFrame:
    rows = {
        "employees": lambda: s.spread(s.employees()),
        "attendance": lambda: s.spread(s.attendance()),
        "leave_requests": lambda: s.spread(s.leave_requests()),
        "payroll": lambda: s.spread(s.payroll()),
    }
    logs = [snapshot_log(rows[t.name](), t, registry.topic(t), wrapped=t.name != "payroll") for t in registry]
    return reduce(DataFrame.unionByName, logs)


def stream_recreated_topic(s: Source) -> DataFrame:
    """Orders of a topic that is created again, with all but low priorities at one more: it starts at offset 0 and still wins."""
    table, kept = CRM["orders"], KeyedState(CRM.select("orders"), work_path(s.spark, "checkpoint"))
    rows = s.read("orders").where("o_orderpriority NOT LIKE '5%'").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cus_id"),
        (F.floor("o_totalprice").cast("bigint") + 1).alias("amount"),
        millis("o_orderdate").alias("order_at"),
    )
    again = snapshot_log(s.spread(rows), table, CRM.topic(table)).withColumn("offset", F.lit(0).cast("bigint"))
    path, half = _store_log(s, s.order_log(CRM))
    for generation in range(2):
        if generation:
            again.write.mode("append").parquet(path)
        log = in_generation(file_log(s.spark, path, format="parquet", max_files=half), generation)
        kept.follow(log, trigger=NOW).awaitTermination()
    return kept.current(s.spark, "orders")


def _group_tables(s: Source) -> dict[str, DataFrame]:
    return current_tables(s.spark, [_kept(s, HRM, _hrm_log(s, HRM))])


def stream_replicate_group(s: Source) -> DataFrame:
    """All personnel tables through one query; the view reads what arrived."""
    return views.build(personnel.VIEWS, _group_tables(s))["overtime_report"]


def stream_group_rows(s: Source) -> DataFrame:
    """The same, with rows, keys and employees counted in each of the targets."""
    return reduce(
        DataFrame.unionByName,
        [
            rows.agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum("emp_id" if name == "employees" else "id").alias("keys"),
                F.countDistinct("emp_id").alias("people"),
            ).select(F.lit(name).alias("tbl"), "rows", "keys", "people")
            for name, rows in _group_tables(s).items()
        ],
    )


def stream_replicate_each(s: Source) -> DataFrame:
    """The reduced personnel tables, one query per table."""
    registry = hrm_reduced().select("employees", "attendance", "payroll")
    log = _stream(s, _hrm_log(s, registry))

    def own(group: Registry) -> DataFrame:
        return log().where(F.col("topic").isin([group.topic(t) for t in group]))

    kept, running = follow_groups(own, registry, work_path(s.spark, "checkpoint"), group_size=1, trigger=NOW)
    for query in running:
        query.awaitTermination()
    tables = current_tables(s.spark, kept)
    late = personnel.late_ranking_by_flag(tables["attendance"], tables["employees"])
    income = personnel.payroll_average_income(tables["payroll"], tables["employees"])
    return late.join(income, "department")


def stream_attendance(s: Source) -> DataFrame:
    registry = HRM.select("attendance")
    return _kept(s, registry, _hrm_log(s, registry)).current(s.spark, "attendance")


def stream_order_summary(s: Source) -> DataFrame:
    """Totals per customer from a log without some old images, which the stream's state then supplies."""
    return _state_totals(s, False)


def stream_keyed_state(s: Source) -> DataFrame:
    """The last event of every user, kept in the state of a stream and read back from there."""
    return _kept(s, USERS, s.event_log()).current(s.spark, "user_state")


def _state_totals(s: Source, complete: bool) -> DataFrame:
    kept = state_totals.StateTotals(CRM.select("orders"), work_path(s.spark, "checkpoint"), "cus_id", "amount", "order_at", buckets=64)
    for query in kept.follow(_stream(s, s.order_log(CRM, complete))(), complete=complete, trigger=NOW):
        query.awaitTermination()
    return state_totals.order_summary(kept.current(s.spark), VIP, HIGH)


def stream_totals_state(s: Source) -> DataFrame:
    """Totals per customer out of signed rows, the log carrying every old image."""
    return _state_totals(s, True)


def domain_sales(s: Source) -> DataFrame:
    """The sales domain from its change logs to its published views."""
    domain = replace(domains.SALES, summary=partial(state_totals.order_summary, vip=VIP, high=HIGH))
    rows = {"customers": s.customers, "products": s.products, "order_items": s.order_items}
    logs = [snapshot_log(s.spread(rows[t.name]()), t, CRM.topic(t)) for t in domain.copied]
    log = _stream(s, reduce(DataFrame.unionByName, [*logs, s.order_log(CRM)]))
    checkpoint = work_path(s.spark, "checkpoint")

    def source(tables: Registry) -> DataFrame:
        return log().where(F.col("topic").isin([tables.topic(t) for t in tables]))

    for query in domain.start(source, checkpoint, trigger=NOW, buckets=64):
        query.awaitTermination()
    domain.publish(s.spark, checkpoint, "live_")
    return s.spark.sql(
        "SELECT r.region, r.customer_count, r.total_revenue, r.total_orders, count(*) AS high_value "
        "FROM live_regional_summary r JOIN live_customer_rfm f ON r.region = f.region "
        "WHERE f.status = 'HIGH_VALUE' GROUP BY r.region, r.customer_count, r.total_revenue, r.total_orders"
    )


# Registry


def checksum(rows: DataFrame) -> list[Column]:
    """Number of rows and a sum over a hash of all columns of every row, whatever their order.

    Fractions enter with six places, nested values as the text they are captured as.
    """

    def plain(field: StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        if kind in ("double", "float"):
            column = F.floor(column.cast("double") * 1_000_000).cast("bigint")
        elif kind.startswith("array<"):
            column = F.array_join(F.transform(column, lambda x: F.floor(x.cast("double") * 1_000_000).cast("string")), ",")
        return F.coalesce(column.cast("string"), F.lit("~"))

    text = F.concat_ws("|", *[plain(f) for f in rows.schema.fields])
    part = F.conv(F.substring(F.md5(F.encode(text, "utf-8")), 1, 15), 16, 10).cast("decimal(20,0)")
    total = F.coalesce(F.sum(part), F.lit(0)) % F.lit(CHECKSUM)
    return [F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("checksum")]


def _versions(s: Source, table: Table, topic: str) -> DataFrame:
    """A given table as messages; line items that share a key are versions of it, in the order of their columns."""
    rows, nth = s.spread_few(s.read(table.name)), F.lit(0)
    if table.name == "lineitem":
        rows = s.read(table.name)
        nth = F.row_number().over(Window.partitionBy(*table.key).orderBy(*[F.col(c).asc_nulls_first() for c in rows.columns]))
    return versioned_log(captured(rows.withColumn("_nth", nth.cast("bigint"))), table, topic, "_nth")


def _given_log(s: Source, registry: Registry) -> DataFrame:
    return reduce(DataFrame.unionByName, [_versions(s, t, registry.topic(t)) for t in registry])


def _restored(s: Source, table: Table, rows: DataFrame) -> DataFrame:
    """Captured rows with nested columns read back from their text."""
    nested = {f.name: f.dataType for f in s.read(table.name).schema.fields if f.dataType.simpleString().startswith("array")}
    return rows.withColumns({name: F.from_json(name, kind) for name, kind in nested.items()}) if nested else rows


def _reports(s: Source, registry: Registry, current: Callable[[Table], DataFrame]) -> DataFrame:
    """A row for each table. They are made one after the other, so that the disks hold the exchanges of one table at a time."""
    path = work_path(s.spark, "reports")
    with dropping_shuffles(s.spark):
        for table in registry:
            rows = _restored(s, table, current(table))
            rows.agg(*checksum(rows)).select(F.lit(table.name).alias("tbl"), "rows", "checksum").write.mode("append").parquet(path)
    return s.spark.read.schema("tbl string, rows bigint, checksum bigint").parquet(path)


def registry_replicate(s: Source) -> DataFrame:
    """Every table of the folder through its change log, by one generic job, with a checksum of all its columns."""
    registry = generic_registry(s)

    def current(table: Table) -> DataFrame:
        log = _versions(s, table, registry.topic(table))
        return table.project(current_rows(changes(log, table), table.key, table.row_type))

    return _reports(s, registry, current)


def stream_fan_out(s: Source) -> DataFrame:
    """Every table of the folder out of one log, by one streaming query with one write."""
    registry = generic_registry(s)
    kept = FanOut(registry, work_path(s.spark, "targets"))
    with dropping_shuffles(s.spark):
        kept.follow(_stream(s, _given_log(s, registry))(), work_path(s.spark, "checkpoint"), trigger=NOW).awaitTermination()
    return _reports(s, registry, lambda table: kept.current(s.spark, table))


SOURCE_TYPES = {"bigint": "BIGINT NOT NULL", "int": "INT DEFAULT '0'", "double": "DOUBLE", "timestamp_ntz": "DATETIME(6)", "timestamp": "DATETIME(6)", "string": "VARCHAR(255) COMMENT 'a, (b)'"}


def own_ddl(s: Source) -> DataFrame:
    """The statements that would make the given tables in a database, a row for each."""
    keys = {t.name: t.key for t in generic_registry(s)}
    texts = []
    for name, key in keys.items():
        columns = [f"  `{f.name}` {SOURCE_TYPES.get(f.dataType.simpleString(), 'JSON')}" for f in s.read(name).schema.fields]
        texts.append(f"-- {name}\nCREATE TABLE IF NOT EXISTS `shop`.`{name}` (\n" + ",\n".join([*columns, f"  PRIMARY KEY ({', '.join(key)})"]) + "\n) ENGINE=x;")
    return s.spark.range(1).select(F.explode(F.array(*[F.lit(text) for text in texts])).alias("ddl"))


def registry_from_ddl(s: Source) -> DataFrame:
    """Columns of the tables that their own DDL declares, and how many values each has in the rows that are captured by it."""
    texts = own_ddl(s)
    registry = ddl.registry(texts, "shop", "shop")
    counts = []
    for table in registry:
        rows = captured(s.read(table.name)).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in table.row_type.fields])
        filled = rows.agg(*[F.count(f"`{f.name}`").alias(f.name) for f in table.row_type.fields])
        listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("filled")) for c in filled.columns])
        counts.append(filled.select(F.explode(listed).alias("c")).select("c.*", F.lit(table.name).alias("table_name")))
    columns = ddl.types_of(ddl.columns_of(texts)).withColumn("is_key", F.col("key_position").isNotNull()).drop("column_type", "key_position")
    return columns.join(reduce(DataFrame.unionByName, counts), ["table_name", "column_name"])


def generic_admin() -> Registry:
    """All administration tables with the generic columns: their key, a name and a time."""

    def columns(t: Table) -> str:
        return ", ".join([*[f"`{k}` string" for k in t.key], *[f"{c} {kind}" for c, kind in (("name", "string"), ("created_at", "bigint")) if c not in t.key]])

    return replace(ADMIN, tables=tuple(Table(t.name, t.key, columns(t), t.target) for t in ADMIN))


def registry_admin_all(s: Source) -> DataFrame:
    """All administration tables out of one log by one call: each event is a row of one of them, dealt out by its number."""
    registry = generic_admin()
    topics = F.array(*[F.lit(registry.topic(t)) for t in registry])
    rows = s.spread(s.read("events")).select("event_id", "event_type", micros("ts").alias("created_at"), F.pmod("event_id", F.lit(len(registry))).cast("int").alias("place"))
    keys = {t.key[0] for t in registry}
    images = F.struct(*[F.col("event_id").cast("string").alias(k) for k in sorted(keys)], F.col("event_type").alias("name"), "created_at")
    log = rows.select(
        F.get(topics, F.col("place")).alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        message(envelope(F.lit("c"), F.lit(None).cast("string"), images)).alias("value"),
    )
    kept = FanOut(registry, work_path(s.spark, "targets"))
    kept.follow(_stream(s, log)(), work_path(s.spark, "checkpoint"), trigger=NOW).awaitTermination()
    arrived = kept.latest(s.spark).where("op <> 'd'").select(
        "target", F.get_json_object("key", "$[0]").alias("id"), variant_field("row", "name", "string").alias("name"), variant_field("row", "created_at", "bigint").alias("created_at")
    )
    frame = arrived.select("id", "name", "created_at")
    return arrived.groupBy(F.col("target").alias("tbl")).agg(*checksum(frame))


def registry_admin(s: Source) -> DataFrame:
    """Administration tables, each through its own log, then a view over what arrived."""
    rows = {
        "dossiers": s.dossiers,
        "registrations": s.registrations,
        "enterprise": s.enterprise,
    }
    current = {}
    for table in ADMIN.select(*rows):
        log = snapshot_log(s.spread(rows[table.name]()), table, ADMIN.topic(table))
        current[table.name] = table.project(current_rows(changes(log, table), table.key, table.row_type))
    return adm.enterprise_activity(current["enterprise"], current["dossiers"], current["registrations"])


def generic_projection(s: Source) -> DataFrame:
    rows = s.read("events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("name"), micros("ts").alias("created_at")
    )
    return transforms.generic_projection(rows)


def time_columns(s: Source) -> DataFrame:
    """Raw capture times as dates and timestamps."""
    table = HRM["leave_requests"]
    dated = with_times(s.leave_requests(), table, "_date")
    return dated.select("id", F.col("start_date_date").cast("string").alias("start"), F.col("end_date_date").cast("string").alias("end"))


def copy_employees_demo(s: Source) -> DataFrame:
    table = DEMO["employees"]
    rows = s.read("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("salary")
    )
    log = snapshot_log(rows, table, DEMO.topic(table), wrapped=False)
    return table.project(current_rows(changes(log, table), table.key, table.row_type))


# Writes


def upsert_subset(s: Source) -> DataFrame:
    """Customers as entered with every order: known ones change region, segment and channel only."""
    entered = s.read("orders").select(
        (F.col("o_custkey") * 2).alias("cus_id"),
        F.concat(F.lit("Customer of order "), F.col("o_orderkey")).alias("name"),
        F.concat(F.col("o_orderkey"), F.lit("@example.com")).alias("email"),
        F.lit(0).alias("create_at"),
        F.col("o_orderpriority").alias("region"),
        F.col("o_orderstatus").alias("segment"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("registered_channel"),
        "o_orderkey",
    )
    return upsert(s.customers(), entered, ["cus_id"], ["region", "segment", "registered_channel"], "o_orderkey")


def upsert_unique_key(s: Source) -> DataFrame:
    """Limits per type and target: a conflict on that pair changes the value and leaves the primary key alone."""
    return upsert(_limits(s), _entered_limits(s), ["limit_type", "target"], ["max_value"], "s_suppkey")


def _limits(s: Source) -> DataFrame:
    return s.read("customer").groupBy(
        F.col("c_mktsegment").alias("limit_type"), F.col("c_nationkey").cast("string").alias("target")
    ).agg(
        F.concat(F.lit("LIM-"), F.min("c_custkey")).alias("limit_id"), F.max("c_acctbal").alias("max_value")
    )


def _entered_limits(s: Source) -> DataFrame:
    return s.read("supplier").select(
        F.when(F.col("s_acctbal") > 5000, "BUILDING").otherwise("SUPPLY").alias("limit_type"),
        F.col("s_nationkey").cast("string").alias("target"),
        F.concat(F.lit("SUP-"), F.col("s_suppkey")).alias("limit_id"),
        F.col("s_acctbal").alias("max_value"),
        "s_suppkey",
    )


def upsert_two_keys(s: Source) -> DataFrame:
    """Limits with two unique keys: some rows meet one by its primary key, some by type and target, and some none."""
    limits = _limits(s)
    entered = _entered_limits(s).groupBy("limit_type", "target").agg(
        F.min("limit_id").alias("limit_id"), F.max("max_value").alias("max_value")
    )
    moved = limits.where("limit_type = 'MACHINERY'").select(
        F.lit("MOVED").alias("limit_type"), "target", "limit_id", (F.col("max_value") + 1).alias("max_value")
    )
    return upsert_any(limits, entered.unionByName(moved), [["limit_id"], ["limit_type", "target"]])


def full_reload(s: Source) -> DataFrame:
    """A table replaced twice by the same rows."""
    path = work_path(s.spark, "reload")
    reload(s.leave_requests().withColumn("days", F.col("days") + 1), path)
    for _ in range(2):
        reload(s.leave_requests(), path)
    return scan(s.spark, path, HRM["leave_requests"].row_type)


def append_with_defaults(s: Source) -> DataFrame:
    """Events booked as orders without an id; those worth nothing get the default amount."""
    booked = s.read("events").select(
        F.col("user_id").alias("cus_id"),
        F.when(F.col("value") >= 1, F.floor("value").cast("bigint")).alias("amount"),
        "event_id",
    )
    return append(s.orders(), booked, "id", ["event_id"], {"amount": 1, "order_at": 0})


def empty_bootstrap(s: Source) -> DataFrame:
    """Counts over two written tables and one that was never written, with a view on the latter."""
    results = scan(s.spark, work_path(s.spark, "never"), ADMIN["dn_inspection_result"].row_type)
    return views.table_counts(
        {
            "employees": s.employees(),
            "dossiers": s.dossiers(),
            "dn_inspection_result": results,
            "dn_inspection_stats": adm.dn_inspection_stats(results),
        }
    )


def table_counts(s: Source) -> DataFrame:
    return views.table_counts(
        {
            "employees": s.employees(),
            "attendance_raw": _attendance(s),
            "leave_requests_raw": s.leave_requests(),
            "payroll_raw": _payroll(s),
            "customers": s.customers(),
            "order_summary": _summary(s),
            "product_catalog": s.products(),
            "order_items_raw": s.order_items(),
        }
    )


def rebuilt_views(s: Source) -> DataFrame:
    """All sales views registered, dropped and created again, then read by SQL."""
    tables = {
        "customers": s.customers(),
        "orders": s.orders(),
        "products": s.products(),
        "order_items": s.order_items(),
    }
    views.register(s.spark, sales.VIEWS, tables, prefix="crm_")
    views.rebuild(s.spark, sales.VIEWS, tables, prefix="crm_")
    return s.spark.sql(
        "SELECT r.region, r.customer_count, count(f.cus_id) AS vip_count "
        "FROM crm_regional_summary r JOIN crm_customer_rfm f ON r.region = f.region "
        "WHERE f.frequency >= 3 GROUP BY r.region, r.customer_count"
    )


# Views kept up to date


def view_regional_delta(s: Source) -> DataFrame:
    """Revenue by region, kept through the changes of orders and customers in two batches; no table is summed again.

    It begins with the orders as they were made. Their log then moves and deletes some, and customers of the last two segments move to the next
    region; the orders' totals per customer and the regions' totals follow by what changed.
    """
    table = CRM["orders"]
    log = _written(s, weighted(changes(s.order_log(CRM, complete=True).where(F.col("offset") % 4 != 0), table), table.row_type), "log")
    summary = _written(s, incremental.summary_of(s.orders()), "summary")
    moved = _written(s, _moved_customers(s), "moved")
    customers = _written(s, s.customers().select("cus_id", "region"), "customers")
    regions = _written(s, incremental.regions_of(customers, summary), "regions")
    keep = lambda frame: _written(s, frame, "sums")
    for half in range(2):
        orders = log.where(F.pmod("id", F.lit(2)) == half)
        d_customers = moved.where(F.pmod("cus_id", F.lit(2)) == half)
        d_summary = _written(s, incremental.summary_delta(summary, orders, keep), "changes")
        d_regions = incremental.regions_delta(regions, customers, d_customers, summary, d_summary, keep)
        summary, customers, regions = (
            _written(s, deltas.applied(rows, signed, key), name)
            for rows, signed, key, name in ((summary, d_summary, ["cus_id"], "summary"), (customers, d_customers, ["cus_id"], "customers"), (regions, d_regions, ["region"], "regions"))
        )
    return regions.withColumnRenamed(deltas.ROWS, "customer_count")


def _moved_customers(s: Source) -> DataFrame:
    """Signed rows of the customers that move: out of their region, into the next one in order."""
    names = [r["r_name"] for r in s.read("region").orderBy("r_regionkey").collect()]
    following = F.create_map(*[F.lit(n) for pair in zip(names, [*names[1:], names[0]], strict=True) for n in pair])
    moving = s.customers().where(F.col("segment").isin("BUILDING", "MACHINERY"))
    images = F.array(F.struct(F.lit(-1).cast("bigint").alias("weight"), F.col("region").alias("region")), F.struct(F.lit(1).cast("bigint").alias("weight"), following[F.col("region")].alias("region")))
    return moving.select("cus_id", F.explode(images).alias("i")).select("cus_id", "i.region", "i.weight")


def _written(s: Source, frame: DataFrame, name: str) -> DataFrame:
    path = work_path(s.spark, name)
    frame.write.parquet(path)
    return s.spark.read.schema(frame.schema).parquet(path)


def category_orders_merged(s: Source) -> DataFrame:
    """Orders per category out of bitmaps that were stored by category and year of shipping, the facts not being read again."""
    rows = s.read("lineitem").select("l_orderkey", "l_partkey", F.year("l_shipdate").alias("year"))
    placed = rows.join(s.products().select("product_id", "category"), F.col("l_partkey") == F.col("product_id"))
    stored = _written(s, distinct.parts(placed, ["category", "year"], "l_orderkey"), "bitmaps")
    return distinct.counts(stored, ["category"], "order_count")


def _saved(s: Source, facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    saved = Colocated(f"saved_{uuid.uuid4().hex[:12]}", work_path(s.spark, "colocated"), key, s.spark.sparkContext.defaultParallelism)
    saved.save(facts, dimension)
    return saved.joined(s.spark)


def attendance_summary_saved(s: Source) -> DataFrame:
    """Attendance with its employees out of saved targets that are bucketed by employee."""
    joined = _saved(s, _attendance(s), s.employees(), "emp_id")
    return joined.where("name <> ''").select("emp_id", "name", "department", "status", "work_hours", "check_in", "check_out")


def category_revenue_saved(s: Source) -> DataFrame:
    """Revenue per category out of saved targets that are bucketed by product."""
    joined = _saved(s, s.order_items(), s.products().select("product_id", "category"), "product_id")
    value = F.col("quantity") * F.col("unit_price")
    return joined.groupBy("category").agg(F.countDistinct("order_id").alias("order_count"), F.sum(value).alias("total_revenue"), F.sum("quantity").alias("total_qty"))


def lookup_ranges(s: Source) -> DataFrame:
    """The orders that the dearest line items belong to, looked up by key in a target written in ranges."""
    path = work_path(s.spark, "ranges")
    rows = s.orders()
    skipping.write(rows, path, "id", 64)
    wanted = _written(s, s.read("lineitem").where("l_discount >= 0.1 AND l_quantity >= 49").select(F.col("l_orderkey").alias("id")), "wanted")
    return skipping.lookup(s.spark, path, wanted, "id", rows.schema)


def reload_generations(s: Source) -> DataFrame:
    """A catalogue table replaced twice, the second time out of itself, with a reload in between that fails half way."""
    table, root = f"reloaded_{uuid.uuid4().hex[:12]}", work_path(s.spark, "generations")
    days = F.col("days")
    generations.reload(s.leave_requests().withColumn("days", days + 1), table, root)
    broken = s.leave_requests().withColumn("days", F.when(F.col("id") % 7 == 0, F.raise_error(F.lit("lost")).cast("int")).otherwise(days))
    try:
        generations.reload(broken, table, root)
    except Exception as error:  # noqa: BLE001
        if "lost" not in str(error):
            raise
    generations.reload(s.spark.table(table).withColumn("days", days - 1), table, root)
    generations.forget(s.spark, table, root)
    return s.spark.table(table)


def top_products_5(s: Source) -> DataFrame:
    view = next(v for v in sales.VIEWS if v.name == "top_products")
    return views.report(sales.top_products(s.order_items(), s.products()), view, limit=5)


def _frames() -> dict[str, Callable[[Source], DataFrame]]:
    hrm, basic = personnel, HRM_BASIC["attendance"]

    def copy(registry: Registry, name: str, rows: str) -> Callable[[Source], DataFrame]:
        return lambda s: registry[name].project(getattr(s, rows)())

    return {
        "customer_rfm": lambda s: sales.customer_rfm(s.customers(), _summary(s), HIGH, LOYAL),
        "attendance_analytics": _attendance,
        "attendance_local_clock": lambda s: transforms.attendance_analytics(s.attendance(), 0),
        "attendance_basic": lambda s: basic.project(s.attendance()),
        "attendance_reduced": lambda s: hrm_reduced()["attendance"].project(s.attendance()),
        "payroll_progressive": _payroll,
        "payroll_flat": lambda s: hrm_reduced()["payroll"].project(s.payroll()),
        "order_summary": _summary,
        "order_summary_dedup_max": lambda s: sales.order_summary_max(_summary_versions(s)),
        "order_summary_latest": lambda s: sales.order_summary_latest(_summary_versions(s)),
        "order_summary_newest": order_summary_newest,
        "attendance_summary": lambda s: hrm.attendance_summary(_attendance(s), s.employees()),
        "department_stats": lambda s: hrm.department_stats(_attendance(s), s.employees()),
        "late_ranking": lambda s: hrm.late_ranking(_attendance(s), s.employees()),
        "leave_analysis": lambda s: hrm.leave_analysis(s.leave_requests(), s.employees()),
        "payroll_summary": lambda s: hrm.payroll_summary(_payroll(s), s.employees()),
        "overtime_report": lambda s: hrm.overtime_report(_attendance(s), s.employees()),
        "attendance_summary_unguarded": lambda s: hrm.attendance_summary(
            basic.project(s.attendance()), s.employees(), guard=False
        ),
        "department_stats_unguarded": lambda s: hrm.department_stats(
            basic.project(s.attendance()), s.employees(), guard=False
        ),
        "late_ranking_unguarded": lambda s: hrm.late_ranking(
            basic.project(s.attendance()), s.employees(), guard=False
        ),
        "leave_analysis_unguarded": lambda s: hrm.leave_analysis(s.leave_requests(), s.employees(), guard=False),
        "payroll_summary_v2": lambda s: hrm.payroll_summary_gross(s.payroll(), s.employees()),
        "late_ranking_flag": lambda s: hrm.late_ranking_by_flag(
            hrm_reduced()["attendance"].project(s.attendance()), s.employees()
        ),
        "payroll_avg_income": lambda s: hrm.payroll_average_income(
            hrm_reduced()["payroll"].project(s.payroll()), s.employees()
        ),
        "regional_summary": lambda s: sales.regional_summary(s.customers(), _summary(s)),
        "category_revenue": lambda s: sales.category_revenue(s.order_items(), s.products()),
        "top_products": lambda s: sales.top_products(s.order_items(), s.products()),
        "top_products_5": top_products_5,
        "dossier_summary": lambda s: adm.dossier_summary(s.dossiers()),
        "alert_dashboard": lambda s: adm.alert_dashboard(s.alerts()),
        "registration_stats": lambda s: adm.registration_stats(s.registrations()),
        "invoice_revenue": lambda s: adm.invoice_revenue(s.invoices()),
        "enterprise_activity": lambda s: adm.enterprise_activity(s.enterprise(), s.dossiers(), s.registrations()),
        "dn_inspection_stats": lambda s: adm.dn_inspection_stats(s.dn_inspection_result()),
        "table_counts": table_counts,
        "rebuilt_views": rebuilt_views,
        "cdc_unwrap": cdc_unwrap,
        "cdc_dead_letters": cdc_dead_letters,
        "cdc_snapshot_then_changes": cdc_snapshot_then_changes,
        "cdc_chunked_snapshot": cdc_chunked_snapshot,
        "cdc_current_state": cdc_current_state,
        "cdc_weighted_totals": cdc_weighted_totals,
        "stream_replicate": stream_replicate,
        "stream_recreated_topic": stream_recreated_topic,
        "stream_replicate_group": stream_replicate_group,
        "stream_group_rows": stream_group_rows,
        "stream_replicate_each": stream_replicate_each,
        "stream_attendance": stream_attendance,
        "stream_order_summary": stream_order_summary,
        "stream_keyed_state": stream_keyed_state,
        "stream_totals_state": stream_totals_state,
        "domain_sales": domain_sales,
        "registry_replicate": registry_replicate,
        "registry_admin": registry_admin,
        "registry_admin_all": registry_admin_all,
        "registry_from_ddl": registry_from_ddl,
        "stream_fan_out": stream_fan_out,
        "generic_projection": generic_projection,
        "time_columns": time_columns,
        "copy_employees_demo": copy_employees_demo,
        "copy_employees": copy(HRM, "employees", "employees"),
        "copy_leave_requests": copy(HRM, "leave_requests", "leave_requests"),
        "copy_payroll": copy(HRM_BASIC, "payroll", "payroll"),
        "copy_customers": copy(CRM, "customers", "customers"),
        "copy_product_catalog": copy(CRM, "products", "products"),
        "copy_order_items": copy(CRM, "order_items", "order_items"),
        "view_regional_delta": view_regional_delta,
        "category_orders_merged": category_orders_merged,
        "reload_generations": reload_generations,
        "attendance_summary_saved": attendance_summary_saved,
        "category_revenue_saved": category_revenue_saved,
        "lookup_ranges": lookup_ranges,
        "upsert_subset": upsert_subset,
        "upsert_unique_key": upsert_unique_key,
        "upsert_two_keys": upsert_two_keys,
        "full_reload": full_reload,
        "append_with_defaults": append_with_defaults,
        "empty_bootstrap": empty_bootstrap,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over(frame: Callable[[Source], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: frame(Source(spark, folder))

    return {name: over(frame) for name, frame in _frames().items()}
