"""License scans by diagonal voting, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from changeloom.llm.frames import LOWER

#: The phrases whose every place is reported, and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Longer wordings, found even if a few of their words are changed, missing or added.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "released under the creative commons zero public domain dedication"),
)
#: Word characters, as in ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Diagonals this close are one candidate; a wording counts if this part of its word pairs stands there.
NEAR, ENOUGH = 2, 0.75


def _pairs(spark: SparkSession) -> DataFrame:
    """A row for each word pair of each phrase and template: a few hundred, by the two lists above."""
    rows = []
    for t, (label, text) in enumerate((*PHRASES, *TEMPLATES)):
        words = text.split()
        rows += [(t, label, t < len(PHRASES), len(words) - 1, i, *pair) for i, pair in enumerate(zip(words, words[1:]))]
    frame = spark.createDataFrame(rows, "template int, label string, base boolean, pairs int, at int, first string, second string")
    return frame.withColumn("gram", F.xxhash64("first", "second"))


def scan(docs: DataFrame) -> DataFrame:
    """Every span of a license wording: ``doc_id``, ``text_key``, ``label``, ``base``, ``start``, ``end`` (words from 0), ``score``.

    The hash of each pair of neighbouring words of a text is joined to the places of that pair in the wordings. A hit votes for
    its diagonal, text place less wording place. A phrase stands on a diagonal that has all its votes. For the longer
    wordings, diagonals at most two apart are merged, and a candidate counts if three quarters of the wording's pairs
    are there, within one and a half times its length. Texts are read whole. Null and empty texts, and those of one word, have no
    spans. Rows that share ``doc_id`` and text have the same spans, once.
    """
    text = F.coalesce(F.translate("text", *LOWER), F.lit(""))
    listed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.array_remove(F.split(text, BREAKS), "").alias("words"))
    pairs = (
        listed.where(F.size("words") > 1)
        .select("doc_id", "text_key", F.posexplode(F.arrays_zip(F.col("words").alias("a"), F.expr("slice(words, 2, size(words) - 1)").alias("b"))))
        .select("doc_id", "text_key", F.col("pos"), F.col("col.a"), F.col("col.b"))
        .where("b is not null")
        .withColumn("gram", F.xxhash64("a", "b"))
    )
    hits = (
        pairs.join(F.broadcast(_pairs(docs.sparkSession)), "gram")
        .where("a = first and b = second")
        .select("doc_id", "text_key", "template", "label", "base", "pairs", "at", (F.col("pos") - F.col("at")).alias("diagonal"))
    )
    place = ["doc_id", "text_key", "template", "label", "base", "pairs"]
    votes = hits.groupBy(*place, "diagonal").agg(F.collect_set("at").alias("ats"))
    exact = votes.where("base and size(ats) = pairs").select(
        "doc_id", "text_key", "label", "base", F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("pairs") + 1).alias("end"), F.lit(1.0).alias("score"),
    )
    along = Window.partitionBy(*place).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > NEAR
    merged = (
        votes.where("not base")
        .withColumn("island", F.sum(F.when(apart, 1).otherwise(0)).over(along))
        .select(*place, "island", "diagonal", F.explode("ats").alias("at"))
        .groupBy(*place, "island")
        .agg(
            F.count_distinct("at").alias("found"),
            F.min(F.col("diagonal") + F.col("at")).alias("start"),
            (F.max(F.col("diagonal") + F.col("at")) + 2).alias("end"),
        )
    )
    loose = merged.where((F.col("found") >= ENOUGH * F.col("pairs")) & (F.col("end") - F.col("start") <= 1.5 * (F.col("pairs") + 1)))
    return exact.unionByName(loose.select("doc_id", "text_key", "label", "base", "start", "end", (F.col("found") / F.col("pairs")).alias("score")))


def summarize(docs: DataFrame) -> DataFrame:
    """One row per document: its words, all places of the phrases, the first and last of them, and all labels.

    Null text counts as empty. Repeated rows each get their row.
    """
    labels = lambda keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")
    base = F.col("base")
    found = scan(docs).groupBy("doc_id", "text_key").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.lit(True)).alias("labels"),
        F.max("score").alias("score"),
    )
    words = F.size(F.array_remove(F.split(F.coalesce(F.translate("text", *LOWER), F.lit("")), BREAKS), ""))
    every = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words.cast("bigint").alias("n_words"))
    same = every["doc_id"].eqNullSafe(found["doc_id"]) & (every["text_key"] == found["text_key"])
    return every.join(found, same, "left").select(
        every["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
