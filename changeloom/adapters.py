"""Domain tables out of the generic order, customer and event tables used for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeloom.registry import ORDERS, Registry, Table
from changeloom.sources.changelog import envelope, message

# Value tiers that suit the amounts of the order table.
VIP, HIGH, LOYAL = 3_500_000, 2_000_000, 1_000_000


class Source:
    """The tables of one data folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        # Times without a zone are read as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def spread(self, frame: DataFrame) -> DataFrame:
        """Rows about to be turned into messages, dealt evenly over all cores."""
        return frame.repartition(self.spark.sparkContext.defaultParallelism)

    def spread_few(self, read: DataFrame) -> DataFrame:
        """The same for a table as it is read, where it has fewer pieces than there are cores; others stay where they are."""
        pieces = read._jdf.queryExecution().toRdd().getNumPartitions()
        return self.spread(read) if pieces < self.spark.sparkContext.defaultParallelism else read

    # Personnel

    def employees(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("emp_id"),
            F.when(F.col("c_custkey") % 50 == 0, "").otherwise(F.col("c_name")).alias("name"),
            F.col("c_mktsegment").alias("department"),
            F.col("c_acctbal").alias("salary"),
        )

    def attendance(self) -> DataFrame:
        start = millis("ts")
        end = start + F.floor(F.col("value") * 400000).cast("bigint")
        kind = F.col("event_type")
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("emp_id"),
            F.when(F.col("event_id") % 17 != 0, start).alias("check_in"),
            F.when(F.col("event_id") % 19 != 0, end).alias("check_out"),
            F.when(kind == "error", "LATE").when(kind == "view", "EARLY_LEAVE").otherwise("ON_TIME").alias("status"),
        )

    def leave_requests(self) -> DataFrame:
        days = (F.col("o_orderkey") % 5 + 1).cast("int")
        first = F.unix_date(F.col("o_orderdate").cast("date"))
        priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("emp_id"),
            F.when(priority.startswith("1"), "sick").when(priority.startswith("2"), "annual").otherwise("unpaid").alias("leave_type"),
            first.alias("start_date"),
            (first + days - 1).alias("end_date"),
            days.alias("days"),
            F.when(status == "P", "pending").when(status == "F", "approved").otherwise("rejected").alias("status"),
            priority.alias("reason"),
        )

    def payroll(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("emp_id"),
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            (price * 90).alias("base_salary"),
            (price * 2).alias("deduction"),
            (price * 12).alias("bonus"),
            (price * 100).alias("net_salary"),
        )

    # Sales

    def customers(self) -> DataFrame:
        place = self.read("nation").join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        channel = F.col("c_custkey") % 3
        return self.read("customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("cus_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            (F.col("c_custkey") % 20000).cast("int").alias("create_at"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("segment"),
            F.when(channel == 0, "web").when(channel == 1, "app").otherwise("store").alias("registered_channel"),
        )

    def orders(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("cus_id"),
            F.floor("o_totalprice").cast("bigint").alias("amount"),
            millis("o_orderdate").alias("order_at"),
        )

    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.floor("p_retailprice").cast("bigint").alias("price"),
        )

    def order_items(self) -> DataFrame:
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.floor("l_extendedprice").cast("bigint").alias("unit_price"),
        )

    # Administration

    def dossiers(self) -> DataFrame:
        shipped = self.read("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped"))
        orders = self.read("orders")
        return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            F.concat(F.lit("DOS-"), F.col("o_orderkey")).alias("dossier_id"),
            F.col("o_custkey").cast("string").alias("tax_code"),
            F.col("o_orderpriority").alias("procedure_type"),
            F.when(F.col("o_orderkey") % 13 != 0, micros("o_orderdate")).alias("submitted_at"),
            F.when(F.col("o_orderstatus") != "O", micros("shipped")).alias("processed_at"),
            F.col("o_orderstatus").alias("status"),
            F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0).alias("is_deleted"),
        )

    def alerts(self) -> DataFrame:
        value, kind = F.col("value"), F.col("event_type")
        return self.read("events").select(
            F.concat(F.lit("ALT-"), F.col("event_id")).alias("alert_id"),
            kind.alias("alert_type"),
            F.when(value < 10, "INFO").when(value < 50, "WARNING").otherwise("CRITICAL").alias("severity"),
            F.when(kind == "purchase", "RESOLVED").when(value > 30, "ACKNOWLEDGED").otherwise("NEW").alias("status"),
        )

    def registrations(self) -> DataFrame:
        value = F.col("value")
        return self.read("events").select(
            F.concat(F.lit("REG-"), F.col("event_id")).alias("id"),
            (F.col("event_id") % 3).cast("int").alias("amend_version"),
            F.col("user_id").cast("string").alias("enterprise_id"),
            F.col("event_type").alias("procedure_code"),
            F.when(value < 5, "RECEIVED").when(value < 20, "PROCESSING").otherwise("APPROVED").alias("status"),
            F.upper("event_type").alias("procedure_name"),
        )

    def invoices(self) -> DataFrame:
        return self.read("orders").select(
            F.concat(F.lit("INV-"), F.col("o_orderkey")).alias("id"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderstatus").alias("status"),
        )

    def enterprise(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").cast("string").alias("tax_code"), F.col("c_name").alias("enterprise_name")
        )

    def dn_inspection_result(self) -> DataFrame:
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("inspection_dossier_id"),
            F.col("l_returnflag").alias("result_content"),
        )

    # Change logs

    def event_log(self) -> DataFrame:
        """Events as changes to their user: the last one is the user's state, an error deletes it."""
        table = USER_STATE
        after = F.struct("user_id", "event_type", "value")
        error = F.col("event_type") == "error"
        nothing = F.lit(None).cast(table.row_type)
        body = envelope(
            F.when(error, "d").otherwise("u"),
            F.when(error, after).otherwise(nothing),
            F.when(error, nothing).otherwise(after),
            millis("ts"),
        )
        return self.spread(self.read("events")).select(
            F.lit(USERS.topic(table)).alias("topic"),
            F.pmod("user_id", F.lit(8)).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.when(F.col("event_type") == "click", message(body, False)).otherwise(message(body)).alias("value"),
        )

    def order_log(self, registry: Registry, complete: bool = False) -> DataFrame:
        """The life of every order as changes.

        Each is created (as part of the snapshot if it is finished); urgent and high priorities then move to the next
        customer at twice the amount, the high ones without their old image unless ``complete``; pending ones are deleted
        in the end, which also leaves a message without a value. Open orders come in the wrapped form.
        """
        row = ORDERS.row_type
        nothing = F.lit(None).cast(row)
        priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        moves = priority.startswith("1") | priority.startswith("2")
        made = F.struct("id", "cus_id", "amount", "order_at")
        moved = F.struct(
            F.col("id"),
            (F.col("cus_id") + 1).alias("cus_id"),
            (F.col("amount") * 2).alias("amount"),
            (F.col("order_at") + 1000).alias("order_at"),
        )
        old = made if complete else F.when(~priority.startswith("2"), made).otherwise(nothing)
        at = F.col("order_at")

        def step(number: int, happens: Column, op: Column, before: Column, after: Column, value: bool = True) -> Column:
            body = envelope(op, before, after, at)
            text = F.when(status == "O", message(body)).otherwise(message(body, False))
            return F.when(
                happens,
                F.struct(
                    (F.col("id") * 4 + number).alias("offset"),
                    (text if value else F.lit(None).cast("string")).alias("value"),
                ),
            )

        steps = F.array(
            step(0, F.lit(True), F.when(status == "F", "r").otherwise("c"), nothing, made),
            step(1, moves, F.lit("u"), old, moved),
            step(2, status == "P", F.lit("d"), F.when(moves, moved).otherwise(made), nothing),
            step(3, status == "P", F.lit("d"), nothing, nothing, value=False),
        )
        rows = self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("cus_id"),
            F.floor("o_totalprice").cast("bigint").alias("amount"),
            millis("o_orderdate").alias("order_at"),
            "o_orderpriority",
            "o_orderstatus",
        )
        return (
            self.spread(rows)
            .select("id", F.explode(steps).alias("m"))
            .where(F.col("m").isNotNull())
            .select(
                F.lit(registry.topic("orders")).alias("topic"),
                F.pmod("id", F.lit(8)).cast("int").alias("partition"),
                F.col("m.offset").alias("offset"),
                F.col("m.value").alias("value"),
            )
        )


USER_STATE = Table("user_state", ("user_id",), "user_id bigint, event_type string, value double")
USERS = Registry("app", "app", (USER_STATE,))

# Keys of the generic tables, for replicating all of them.
GENERIC_KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
    "documents": ("doc_id",),
    "embeddings": ("vec_id",),
    "pages": ("page_id",),
    "benchmark": ("item_id",),
    "labels": ("doc_id",),
    "conversations": ("conv_id", "turn"),
}


def generic_registry(source: Source) -> Registry:
    """All generic tables, their columns taken from a column catalogue as of a database."""
    names = {"string": "varchar", "timestamp_ntz": "timestamp(6)"}
    catalogue = [
        {
            "table_name": table,
            "column_name": field.name,
            "ordinal_position": position,
            "column_type": names.get(field.dataType.simpleString(), field.dataType.simpleString()),
        }
        for table in GENERIC_KEYS
        for position, field in enumerate(source.read(table).schema.fields)
    ]
    tables = tuple(Table(name, key) for name, key in GENERIC_KEYS.items())
    return Registry("shop", "shop", tables).resolve(catalogue)


def captured(frame: DataFrame) -> DataFrame:
    """Rows as a capture would send them: times as numbers, nested values as JSON text."""

    def raw(field) -> Column:
        kind = field.dataType.simpleString()
        if kind.startswith("timestamp"):
            return micros(field.name).alias(field.name)
        if kind.startswith(("array", "map", "struct")):
            return F.to_json(field.name).alias(field.name)
        return F.col(field.name)

    return frame.select(*[raw(field) for field in frame.schema.fields])


def millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))
