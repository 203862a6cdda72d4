"""Change logs: where the messages come from and how they become typed changes.

A raw log has the columns ``topic string, partition int, offset bigint, value string``. A change has the key columns
of its table, ``op`` (``r`` snapshot, ``c`` create, ``u`` update, ``d`` delete), ``ts_ms``, the row images ``before``
and ``after``, and its ``partition`` and ``offset``. The order of changes to a key is that of their offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from changeloom.registry import Registry, Table

RAW_LOG = "topic string, partition int, offset bigint, value string"
OPS = ("r", "c", "u", "d")
#: Offsets of one life of a topic stay below this; those of its next life go on from here.
LIFE = 1 << 48


def kafka_log(
    spark: SparkSession,
    servers: str,
    registry: Registry,
    *,
    streaming: bool = True,
    max_offsets: int | None = None,
    starting: str = "earliest",
    options: dict[str, str] | None = None,
    generation: int = 0,
) -> DataFrame:
    """The topics of ``registry``. Needs Spark's Kafka connector on the classpath. ``generation``: see ``in_generation``."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(registry.topic(t) for t in registry))
        .option("startingOffsets", starting)
    )
    if streaming and max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    log = reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    return in_generation(log, generation)


def in_generation(log: DataFrame, generation: int) -> DataFrame:
    """The log of topics that were created anew ``generation`` times, its changes ordered after those of earlier lives.

    A new topic starts at offset 0, so by its bare offsets it would lose against rows stored from the old one. Raise the
    number by one, with a new checkpoint, whenever topics are created anew. A snapshot keeps its place before the changes
    of its own generation. An offset that does not fit into a generation fails the job.
    """
    if not 0 <= generation < 1 << 15:
        raise ValueError(f"generation is from 0 to {(1 << 15) - 1}, not {generation}")
    if not generation:
        return log
    fits = F.col("offset") < LIFE - 1
    later = F.col("offset") + F.lit(generation * LIFE)
    return log.withColumn("offset", F.when(fits, later).otherwise(F.raise_error(F.lit("offset beyond its generation")).cast("bigint")))


def file_log(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = True,
    format: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """A log kept as JSON-lines or Parquet files with the raw columns."""
    reader = (spark.readStream if streaming else spark.read).format(format).schema(RAW_LOG)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def snapshot_log(rows: DataFrame, table: Table, topic: str, wrapped: bool = True) -> DataFrame:
    """Existing rows as snapshot messages, placed before every logged change (negative offsets).

    Union it with the log to start from a table that already has data.
    """
    return _row_log(rows, table, topic, wrapped, "r", F.lit(-1))


def versioned_log(rows: DataFrame, table: Table, topic: str, offset: str, wrapped: bool = True) -> DataFrame:
    """Versions of rows as messages at the offsets in a column of theirs."""
    return _row_log(rows, table, topic, wrapped, "c", F.col(offset))


def placed_log(rows: DataFrame, table: Table, topic: str, offset: str, wrapped: bool = True) -> DataFrame:
    """Existing rows as snapshot messages at the offsets in a column of theirs."""
    return _row_log(rows, table, topic, wrapped, "r", F.col(offset))


def _row_log(rows: DataFrame, table: Table, topic: str, wrapped: bool, op: str, offset: Column) -> DataFrame:
    after = F.struct(*[F.col(f"`{c}`") for c in table.row_type.fieldNames()])
    body = envelope(F.lit(op), F.lit(None).cast(table.row_type), after)
    return rows.select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"), message(body, wrapped).alias("value")
    )


def envelope(op: Column, before: Column, after: Column, ts_ms: Column | None = None) -> Column:
    return F.struct(
        op.alias("op"),
        (F.lit(0) if ts_ms is None else ts_ms).cast("bigint").alias("ts_ms"),
        before.alias("before"),
        after.alias("after"),
    )


def message(body: Column, wrapped: bool = True) -> Column:
    """JSON text of an envelope, with or without the outer ``payload``."""
    text = F.to_json(F.struct(body.alias("payload")) if wrapped else body, {"ignoreNullFields": "false"})
    # Never NULL, and known as such, so that no filter has to make the text to find out.
    return F.coalesce(text, F.lit(""))


def parse(log: DataFrame, table: Table) -> DataFrame:
    """Decode the messages of one table in a single pass over the text, in whichever of the two forms each is.

    Messages without a value only mark a key for log clean-up and are dropped. Whatever else cannot be read as a
    change of this table, including a value of the wrong type, has ``bad`` set.
    """
    row = table.row_type
    body = StructType(
        [
            StructField("op", StringType()),
            StructField("ts_ms", LongType()),
            StructField("before", row),
            StructField("after", row),
        ]
    )
    both = StructType([StructField("payload", body), *body.fields, StructField("_unread", StringType())])
    # As rows of a generator, the decoded fields are computed once. As a plain column, the optimizer would move the
    # decoding into every filter and field that refers to it.
    decoded = log.where("value IS NOT NULL").select(
        "topic",
        "partition",
        "offset",
        "value",
        F.inline(F.array(F.from_json("value", both, {"columnNameOfCorruptRecord": "_unread"}))),
    )
    parts = [f"coalesce(payload.{name}, {name}) AS {name}" for name in body.fieldNames()]
    known = ", ".join(f"'{op}'" for op in OPS)
    return decoded.selectExpr("topic", "partition", "offset", "value", *parts, "_unread AS unread").selectExpr(
        "topic",
        "partition",
        "offset",
        "value",
        *body.fieldNames(),
        f"unread IS NOT NULL OR op IS NULL OR op NOT IN ({known}) OR if(op = 'd', before, after) IS NULL AS bad",
    )


def changes(log: DataFrame, table: Table, on_bad: str = "raise") -> DataFrame:
    """Typed changes of one table.

    ``on_bad`` says what happens to unreadable messages: ``raise`` fails the job, ``skip`` leaves them to
    ``bad_messages``. Changes without a key are left out.
    """
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad is 'raise' or 'skip', not {on_bad!r}")
    parsed = parse(log, table)
    image_key = {k: f"coalesce(after.`{k}`, before.`{k}`)" for k in table.key}
    keyed = " AND ".join(f"{column} IS NOT NULL" for column in image_key.values())
    if on_bad == "skip":
        keep = f"NOT bad AND {keyed}"
    else:
        # Part of the filter, so that no pruning or reordering can lose the check.
        failure = "raise_error(concat('unreadable change at ', concat_ws('/', topic, partition, offset)))"
        keep = f"CASE WHEN bad THEN CAST({failure} AS boolean) ELSE {keyed} END"
    keys = [f"{column} AS `{k}`" for k, column in image_key.items()]
    return parsed.where(keep).selectExpr(*keys, "op", "ts_ms", "before", "after", "partition", "offset")


def bad_messages(log: DataFrame, table: Table) -> DataFrame:
    """The unreadable messages, as they came."""
    return parse(log, table).where("bad").select("topic", "partition", "offset", "value")


def variant_changes(log: DataFrame, registry: Registry, on_bad: str = "raise") -> DataFrame:
    """Changes of all tables of ``registry`` in one pass: ``topic``, ``key``, ``op``, ``offset``, ``before``, ``row``.

    ``row`` is the new image (NULL for a delete) and ``before`` the old one, both as VARIANT, so tables of any columns share one
    frame, and a column that the registry does not know yet is carried along. ``key`` is a JSON array of the key's values as text.
    Messages of other topics, without a value, or without a key are left out. ``on_bad`` as for ``changes``; a value that
    cannot be converted to its column's type makes a message unreadable too.
    """
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad is 'raise' or 'skip', not {on_bad!r}")
    parsed = variants(log, registry)
    if on_bad == "skip":
        keep = "NOT bad AND key IS NOT NULL"
    else:
        failure = "raise_error(concat('unreadable change at ', concat_ws('/', topic, partition, offset)))"
        keep = f"CASE WHEN bad THEN CAST({failure} AS boolean) ELSE key IS NOT NULL END"
    return parsed.where(keep).selectExpr("topic", "key", "op", "offset", "before", "if(op = 'd', NULL, after) AS row")


def bad_variants(log: DataFrame, registry: Registry) -> DataFrame:
    """The unreadable messages of all tables, as they came."""
    return variants(log, registry).where("bad").select("topic", "partition", "offset", "value")


def variants(log: DataFrame, registry: Registry) -> DataFrame:
    """The decoded messages of all tables, readable or not. Each generator keeps its step from being copied into later ones."""
    topics = [registry.topic(t) for t in registry]

    def each(case) -> str:
        """The expression that belongs to a message's table; tables with the same one share a branch."""
        branches: dict[str, list[str]] = {}
        for t in registry:
            branches.setdefault(case(t), []).append(_quoted(registry.topic(t)))
        return f"CASE {' '.join(f'WHEN topic IN ({", ".join(own)}) THEN {text}' for text, own in branches.items())} END"

    field = _field
    def key(t: Table) -> str:
        values = [f"coalesce({field('after', k, 'string')}, {field('before', k, 'string')})" for k in t.key]
        return f"if({' OR '.join(f'{v} IS NULL' for v in values)}, NULL, to_json(array({', '.join(values)})))"

    def unfit(t: Table) -> str:
        """Whether some column has a value, other than null, that its type cannot hold."""
        value = lambda f: field("image", f.name, "variant")
        given = lambda f: f"{value(f)} IS NOT NULL AND NOT is_variant_null({value(f)})"
        columns = [f for f in t.row_type.fields if f.dataType.simpleString() != "string"] if t.columns else []
        return " OR ".join([f"({given(f)} AND {field('image', f.name, f.dataType.simpleString())} IS NULL)" for f in columns] or ["false"])

    known = ", ".join(f"'{op}'" for op in OPS)
    there = "if(is_variant_null({0}), NULL, {0})"
    parsed = log.where(F.col("value").isNotNull() & F.col("topic").isin(topics)).selectExpr(
        "topic", "partition", "offset", "value", "inline(array(struct(try_parse_json(value) AS v)))"
    )
    bodies = parsed.selectExpr("topic", "partition", "offset", "value", "inline(array(struct(coalesce(try_variant_get(v, '$.payload', 'variant'), v) AS body)))")
    images = bodies.selectExpr(
        "topic", "partition", "offset", "value",
        "inline(array(struct(try_variant_get(body, '$.op', 'string') AS op, try_variant_get(body, '$.before', 'variant') AS old, try_variant_get(body, '$.after', 'variant') AS new)))",
    )
    plain = images.selectExpr("topic", "partition", "offset", "value", "op", f"{there.format('old')} AS before", f"{there.format('new')} AS after")
    imaged = plain.selectExpr("*", "if(op = 'd', before, after) AS image")
    return imaged.selectExpr(
        "topic", "partition", "offset", "value",
        f"inline(array(struct(op, before, after, {each(key)} AS key, op IS NULL OR op NOT IN ({known}) OR image IS NULL OR {each(unfit)} AS bad)))",
    )


def variant_field(image: str, name: str, kind: str) -> Column:
    """One column of a VARIANT image; NULL if it is missing, null, or not of that kind."""
    return F.expr(_field(image, name, kind))


def _field(image: str, name: str, kind: str) -> str:
    path = f"$['{name}']"
    return f"try_variant_get({image}, {_quoted(path)}, {_quoted(kind)})"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
