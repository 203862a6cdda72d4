"""Chat formatting of reply trees: the best branches as conversations with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from changeloom.session import ensure_checkpoint_dir

#: A turn is "### role:", a line end, the text, a line end, "</turn>", a line end. A backslash before a backslash, "#", "<" or ":" escapes it.
HEAD, MIDDLE, TAIL = "### ", ":\n", "\n</turn>\n"
TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*):\n((?:[^\\#<:]|\\.)*)\n</turn>\n", re.DOTALL)


def escaped(text: Column) -> Column:
    """Text with every character that could begin or end a control string escaped; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\#<:])", r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def branches(nodes: DataFrame, best: int = 1) -> DataFrame:
    """The nodes of each tree's ``best`` branches: ``tree``, ``leaf``, ``rank``, ``depth`` (from 1), ``node``.

    ``nodes`` has ``tree`` and ``node`` (no nulls), ``parent`` and ``score``. Self-joins by doubled steps find each node's ancestor 1, 2, 4 …
    levels up along with its depth and the scores above it, so a path of length n takes log2(n) joins. Leaves rank by the mean
    score of their path, ties by smaller node. The chosen leaves' paths are then put together by the same steps.

    A missing or null parent makes a root; null scores count 0. A node that repeats in its tree counts once, with the least parent.
    Nodes on a cycle have no root and, like what hangs from them, are left out. No nodes give no branches.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    plain = nodes.groupBy("tree", "node").agg(F.min(F.struct("parent", "score")).alias("least"))
    plain = plain.select("tree", "node", F.col("least.parent").alias("parent"), F.coalesce(F.col("least.score").cast("double"), F.lit(0.0)).alias("score"))
    known = plain.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    step = plain.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("bigint").alias("depth"), F.col("score").alias("total")
    ).checkpoint()
    rounds = max(1, step.groupBy("tree").count().agg(F.max("count")).head()[0] or 1).bit_length()
    climbing = step.where("up is not null")
    inner, steps = climbing.select("tree", F.col("up").alias("node")).distinct(), []
    while len(steps) < rounds and not climbing.isEmpty():
        steps.append(climbing)
        above = step.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("also"))
        moved = climbing.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("also")).alias("total")
        ).checkpoint()
        # Nodes that have reached their root are looked up by others and climb no further.
        step, climbing = step.where("up is null").unionByName(moved), moved.where("up is not null")
    leaves = step.where("up is null").join(inner, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy((F.col("total") / F.col("depth")).desc(), "node")
    paths = (
        leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
        .select("tree", F.col("node").alias("leaf"), "rank", "node", "depth").checkpoint()
    )
    for k in range(len(steps) - 1, -1, -1):
        up = steps[k].select("tree", "node", "up")
        paths = paths.unionByName(
            paths.join(up, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth"))
        ).checkpoint()
    return paths


def format_trees(nodes: DataFrame, best: int = 1, learn: str = "assistant") -> DataFrame:
    """Each chosen branch as one text: ``tree``, ``leaf``, ``rank``, ``formatted``, ``loss``.

    ``nodes`` as for ``branches``, with ``role`` and ``text``. ``loss`` lists, in order, the half-open spans of code points of the formatted
    text that hold the texts of ``learn``. Null roles and texts are empty strings. A node that repeats in its tree takes the
    least role and text. Only one conversation has to fit into a task.
    """
    said = nodes.groupBy("tree", "node").agg(F.min(F.struct("role", "text")).alias("said"))
    head = F.concat(F.lit(HEAD), escaped(F.col("said.role")), F.lit(MIDDLE))
    turns = branches(nodes, best).join(said, ["tree", "node"]).select(
        "tree", "leaf", "rank", "depth", head.alias("head"), escaped(F.col("said.text")).alias("body"),
        F.coalesce(F.col("said.role") == learn, F.lit(False)).alias("learned"),
    )
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(TAIL)))
    ends = F.sum(F.length("piece")).over(Window.partitionBy("tree", "leaf", "rank").orderBy("depth"))
    turns = turns.withColumn("stop", ends - len(TAIL)).withColumn("start", F.col("stop") - F.length("body"))
    listed = F.array_sort(F.collect_list(F.struct("depth", "piece", "start", "stop", "learned")))
    return turns.groupBy("tree", "leaf", "rank").agg(listed.alias("turns")).select(
        "tree", "leaf", "rank",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"))).alias("loss"),
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def digest(conversations: DataFrame) -> DataFrame:
    """What reads back from formatted conversations: turns, their hash, and the text under the loss mask."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tree, text, loss in zip(batch["tree"], batch["formatted"], batch["loss"], strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(unescaped(text[span["start"] : span["stop"]]) for span in loss)
                rows.append((tree, len(turns), _sha256(said), len(learned), _sha256(learned), len(text)))
            yield pd.DataFrame(rows, columns=DIGEST.replace(" string", "").replace(" bigint", "").split(", "))

    return conversations.select("tree", "formatted", "loss").mapInPandas(read, DIGEST)


DIGEST = "tree string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def chains(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Rows without a parent as trees of one branch: each answers the row before it, by ``order`` (nulls last) within ``tree``.

    A null tree is a tree named "null". The nodes are numbered from 1.
    """
    keyed = rows.select(F.coalesce(F.col(tree).cast("string"), F.lit("null")).alias("tree"), *order, *[n for n in ("role", "text") if n not in order])
    nth = F.row_number().over(Window.partitionBy("tree").orderBy(*[F.col(name).asc_nulls_last() for name in order])).cast("bigint")
    numbered = keyed.withColumn("node", nth)
    before = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("tree", "node", before.alias("parent"), F.lit(0.0).alias("score"), "role", "text")
