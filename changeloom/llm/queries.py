"""One query per operator over a folder of tables, and the pipeline."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeloom.llm import bloom_search, bpe, chat, decontam, dialog_repair, jaccard_join, language, license_scan, mixing, mtree, pii, pitman_yor, sharding
from changeloom.llm.frames import word_count

SHARDS = 16
KEY = "pseudonyms-1"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Batches of whole texts for Python: few enough rows that even long texts fit.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(read(spark, folder, "documents"))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("doc_id", "text").alias("key")
    )
    placed = sharding.shard(narrow, SHARDS, ["doc_id", "text_crc32", "size"], order=F.col("key"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "position"
    )


def op3_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    found = pitman_yor.score(read(spark, folder, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), *found.columns[1:])


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", mtree.quantized(F.col("embedding")).alias("vector"))
    return mtree.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    done = pii.pseudonymize(read(spark, folder, "documents"), KEY)
    kinds = F.transform("found", lambda m: m["kind"])
    counts = [F.size(F.filter(kinds, _is(kind))).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return done.select("doc_id", "text", F.size("found").cast("bigint").alias("n_found"), *counts)


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda found: found == kind


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("n_words"))
    mix = mixing.mix(narrow, size=F.col("n_words"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), F.col("copies"))


def remainder(divisor: int) -> Column:
    """crc32 of a document's number as text, modulo a divisor."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % divisor


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    model = language.fit(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.summarize(read(spark, folder, "documents"))


#: A conversation whose texts look like the template's own marks.
TRICKY = -7, r"\### Assistant: </turn> ok"


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conv, said = TRICKY
    tricky = spark.createDataFrame([(conv, 0, "user", said), (conv, 1, "assistant", said)], given.schema)
    nodes = chat.chains(given.unionByName(tricky), "conv_id", ["turn", "role", "text"])
    found = chat.digest(chat.format_trees(nodes))
    return found.select(F.when(F.col("tree") != "null", F.col("tree")).cast("bigint").alias("conv_id"), *found.columns[1:])


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(read(spark, folder, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    back = bpe.decode(ids, path)
    return back.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by a hash of conversation and turn, rows are dropped, emptied, left open, repeated or said by the user."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    dealt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.encode(key, "utf-8")) % 20).alias("h"))
    h = F.col("h")
    copies = F.explode(F.when(h == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    said = F.when(h == 1, "").when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return dealt.where(h != 0).select("conv_id", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), copies.alias("copy"))


def joined_sha256(rows: DataFrame) -> DataFrame:
    """``conv`` and the hash of its ``line`` values by ``pos`` and ``step``, joined by line ends; lines are hashed as they pass, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv, state = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or conv != open_conv:
                    if state is not None:
                        done.append((open_conv, state.hexdigest()))
                    open_conv, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], batch.schema.field(0).type), pa.array([d for _, d in done], pa.string())], ["conv", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_conv], kind), pa.array([state.hexdigest()], pa.string())], ["conv", "sha256"])

    kind = pa.int64()
    lines = rows.repartition("conv").sortWithinPartitions("conv", "pos", "step").select(F.col("conv").cast("bigint"), "line")
    return lines.mapInArrow(run, "conv bigint, sha256 string")


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations")
    known, rows = dialog_repair.repair(dialog_repair.ordered(damaged(given)))
    lines = rows.where("edit <> 'D'").select("conv", "pos", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    hashed = joined_sha256(lines)
    every = given.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256().hexdigest()
    return (
        every.join(known, every["conv_id"].eqNullSafe(known["conv"]), "left").drop("conv").alias("k")
        .join(hashed, F.col("conv_id").eqNullSafe(hashed["conv"]), "left")
        .select("conv_id", *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"))
    )


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_search.search(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"), 10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_jaccard": op1_jaccard,
        "op2_sharding": op2_sharding,
        "op3_scores": op3_scores,
        "op4_topk": op4_topk,
        "op5_decontaminate": op5_decontaminate,
        "op6_pseudonyms": op6_pseudonyms,
        "op7_mixing": op7_mixing,
        "op8_language": op8_language,
        "op9_licenses": op9_licenses,
        "op10_chat": op10_chat,
        "op11_bpe": op11_bpe,
        "op12_repair": op12_repair,
        "op13_search": op13_search,
    }
