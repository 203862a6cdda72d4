"""Ranked lexical search over bit-sliced Bloom signatures: bounds for all documents, exact scores for those not excluded."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from changeloom.llm.text import Hasher, parts, scrambled
from changeloom.session import work_path
from changeloom.sources.tables import scan

#: Terms are runs of letters, digits and everything beyond ASCII; A-Z count as a-z.
BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())
#: A term is entered once for each of these numbers of occurrences that it reaches.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024)
#: Bits that an entry sets, and bits of a signature for each entry of the largest document of its class.
HASHES, BITS = 3, 8
#: Documents of a block, and cells (bits) of all its slices.
DOCUMENTS, CELLS = 1024, 1 << 23
#: Bytes of queries that are sent to the executors at a time.
QUERY_BYTES = 1 << 20
#: Fixed values of the score.
UNIT, SCALE, SPREAD = 1_000_000_000, 1000, 75

BLOCK = "width bigint, doc_id array<bigint>, text_key array<bigint>, n array<bigint>, levels int, slices binary, terms array<bigint>, df array<bigint>, n_docs bigint, n_terms bigint"


@dataclass(frozen=True)
class Index:
    """Where the signatures and document frequencies are, how many documents hold a term, and how many terms they hold."""

    path: str
    n_docs: int
    n_terms: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BLOCK).parquet(self.path)


def places(terms: np.ndarray, level: int, width: int) -> list[np.ndarray]:
    """The slices of each term at a level; ``width`` is a power of two."""
    mixed = terms + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    found = []
    for _ in range(HASHES):
        mixed = scrambled(mixed + np.uint64(0x632BE59BD9B4E019))
        found.append((mixed & np.uint64(width - 1)).astype(np.int64))
    return found


def counted(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct words in order of their hashes: text, word, occurrences."""
    docs = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((words, docs))
    docs, words = docs[order], words[order]
    new = np.ones(len(words), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (words[1:] != words[:-1])
    at = np.flatnonzero(new)
    return docs[at], words[at], np.diff(np.append(at, len(words)))


def _signatures(docs: np.ndarray, terms: np.ndarray, tf: np.ndarray, ids: list, keys: list, lengths: np.ndarray) -> Iterator[dict]:
    """Blocks of documents of one class of size each, as slices: a row of bits for each place of the signature, a bit for each document."""
    levels = np.searchsorted(LEVELS, tf, "right")
    sizes = np.bincount(docs, weights=levels, minlength=len(lengths)).astype(np.int64)
    classes = np.frexp(np.maximum(sizes, 32) - 0.5)[1]  # the power of two that holds the entries
    first = np.searchsorted(docs, np.arange(len(lengths) + 1))
    for size in np.unique(classes[sizes > 0]):
        members = np.flatnonzero((classes == size) & (sizes > 0))
        width = BITS << int(size)
        step = max(1, min(DOCUMENTS, CELLS // width))
        for low in range(0, len(members), step):
            block = members[low : low + step]
            row_bytes = -(-len(block) // 8)
            entries = np.concatenate([np.arange(first[d], first[d + 1]) for d in block])
            local = np.repeat(np.arange(len(block)), first[block + 1] - first[block])
            cells = np.zeros(width * row_bytes * 8, np.uint8)
            top = int(levels[entries].max())
            for level in range(top):
                on = levels[entries] > level
                for place in places(terms[entries[on]], level, width):
                    cells[place * (row_bytes * 8) + local[on]] = 1
            yield {
                "width": width, "doc_id": [ids[d] for d in block], "text_key": [keys[d] for d in block], "n": lengths[block].tolist(),
                "levels": top, "slices": np.packbits(cells).tobytes(), "n_docs": len(block), "n_terms": int(lengths[block].sum()),
            }


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Signatures of all documents, in one pass over their whole texts.

    Documents are told apart by id and a 64-bit hash of the text, terms by 64-bit hashes. Those without a term, null texts
    among them, are in no block, as no query can find them. Repeated rows are documents of their own.
    """
    spark = docs.sparkSession

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BREAKS)
        ints = pa.list_(pa.int64())
        schema = pa.schema([("width", pa.int64()), ("doc_id", ints), ("text_key", ints), ("n", ints), ("levels", pa.int32()), ("slices", pa.binary()), ("terms", ints), ("df", ints), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
        for batch in batches:
            for part in parts(batch, 16 << 20):
                words, bounds = hasher.words(part.column(2))
                if not len(words):
                    continue
                found = counted(words, bounds)
                for row in _signatures(*found, part.column(0).to_pylist(), part.column(1).to_pylist(), np.diff(bounds)):
                    yield pa.RecordBatch.from_pylist([row], schema=schema)
                terms, df = np.unique(found[1], return_counts=True)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), pa.array(values)) for values in (terms.view(np.int64), df)]
                yield pa.RecordBatch.from_arrays([{"terms": lists[0], "df": lists[1]}.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)

    path = work_path(spark, "signatures")
    docs.select(F.col(f"`{doc_id}`").cast("bigint"), F.xxhash64(f"`{text}`"), F.col(f"`{text}`")).mapInArrow(build, BLOCK).write.parquet(path)
    total = spark.read.schema(BLOCK).parquet(path).agg(F.sum("n_docs"), F.sum("n_terms")).head()
    return Index(path, total[0] or 0, total[1] or 0)


class Queries:
    """The terms of some items with their weights; they travel with the tasks."""

    def __init__(self, rows: list[tuple[int, int, int]], n_docs: int, n_terms: int):
        """``rows`` of item, term and weight, repeats of the term in the item included."""
        rows = sorted(rows)
        self.items = np.unique(np.array([item for item, _, _ in rows], np.int64))
        item = np.searchsorted(self.items, np.array([item for item, _, _ in rows], np.int64))
        self.terms, self.term = np.unique(np.array([term for _, term, _ in rows], np.int64).view(np.uint64), return_inverse=True)
        self.item, self.weight = item, np.array([weight for _, _, weight in rows], np.int64)
        self.bounds = np.searchsorted(item, np.arange(len(self.items) + 1))
        self.n_docs, self.n_terms = n_docs, n_terms

    def damping(self, n: np.ndarray) -> np.ndarray:
        return 100 - SPREAD + SPREAD * n * self.n_docs // self.n_terms

    def bounds_of(self, row: dict) -> np.ndarray:
        """For each item and each document of a block, a score that the document does not exceed.

        A term that seems to reach a level counts as if it occurred once less often than the next one asks for. It may seem so by other
        terms' bits, never the other way round.
        """
        width, n = row["width"], np.array(row["n"], np.int64)
        slices = np.frombuffer(row["slices"], np.uint8).reshape(width, -1)
        damping = self.damping(n)
        found = np.zeros((len(self.items), len(n)), np.int64)
        before = np.zeros(len(n), np.int64)
        alive = np.arange(len(self.terms))
        for level in range(row["levels"]):
            value = UNIT * (LEVELS[level + 1] - 1) // (SCALE * (LEVELS[level + 1] - 1) + 8 * damping) if level + 1 < len(LEVELS) else np.full(len(n), UNIT // SCALE)
            one, two, three = places(self.terms[alive], level, width)
            bits = slices[one] & slices[two] & slices[three]
            seen = bits.any(axis=1)
            # Terms that reach no level here reach no higher one.
            alive, bits = alive[seen], bits[seen]
            if not len(alive):
                break
            at = np.full(len(self.terms), -1)
            at[alive] = np.arange(len(alive))
            entries = np.flatnonzero(at[self.term] >= 0)
            present = np.unpackbits(bits, axis=1, count=len(n))
            sums = present[at[self.term[entries]]] * self.weight[entries, None].astype(np.int32)
            items, starts = np.unique(self.item[entries], return_index=True)
            found[items] += np.add.reduceat(sums, starts, axis=0, dtype=np.int64) * (value - before)
            before = value
        return found

    def scores(self, items: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The exact scores of one document, given its sorted words, for some items."""
        damping = int(self.damping(np.array([len(words)]))[0])
        entries = np.concatenate([np.arange(self.bounds[i], self.bounds[i + 1]) for i in items])
        terms = self.terms[self.term[entries]]
        tf = np.searchsorted(words, terms, "right") - np.searchsorted(words, terms, "left")
        parts_ = self.weight[entries] * (UNIT * tf // (SCALE * tf + 8 * damping))
        starts = np.concatenate([[0], np.cumsum(self.bounds[items + 1] - self.bounds[items])[:-1]])
        return np.add.reduceat(parts_, starts)


FOUND = "item bigint, doc_id bigint, text_key bigint, bound bigint"


def _found(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
    ids = pa.array(columns[1], pa.int64(), mask=columns[4])
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), ids, pa.array(columns[2]), pa.array(columns[3])], ["item", "doc_id", "text_key", "bound"])


def _described(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (0 where null), keys, and which ids are null."""
    null = np.array([i is None for i in row["doc_id"]])
    return np.array([i or 0 for i in row["doc_id"]], np.int64), np.array(row["text_key"], np.int64), null


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _best_bounds(blocks: DataFrame, queries: Queries, k: int) -> DataFrame:
    """For each item, the ``k`` documents of each task with the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(queries.items)
        kept = [np.zeros((n, k), np.int64) for _ in range(3)]
        nulls = np.zeros((n, k), bool)
        for row in _rows(batches):
            ids, keys, null = _described(row)
            bound = queries.bounds_of(row)
            top = np.argpartition(-bound, min(k, bound.shape[1]) - 1, axis=1)[:, :k]
            both = [np.concatenate([old, new], axis=1) for old, new in zip([*kept, nulls], [np.take_along_axis(bound, top, 1), ids[top], keys[top], null[top]], strict=True)]
            best = np.argpartition(-both[0], k - 1, axis=1)[:, :k]
            *kept, nulls = [np.take_along_axis(values, best, 1) for values in both]
        item = np.repeat(queries.items, k)
        on = kept[0].ravel() > 0
        if on.any():
            yield _found([(item[on], kept[1].ravel()[on], kept[2].ravel()[on], kept[0].ravel()[on], nulls.ravel()[on])])

    return blocks.mapInArrow(run, FOUND)


def _not_excluded(blocks: DataFrame, queries: Queries, least: dict[int, int]) -> DataFrame:
    """Every item and document whose bound reaches the item's tenth-best score known."""
    limits = np.array([max(1, least.get(int(item), 1)) for item in queries.items], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, keys, null = _described(row)
            bound = queries.bounds_of(row)
            items, docs = np.nonzero(bound >= limits[:, None])
            if len(items):
                yield _found([(queries.items[items], ids[docs], keys[docs], bound[items, docs], null[docs])])

    return blocks.mapInArrow(run, FOUND)


def _scored(docs: DataFrame, candidates: DataFrame, queries: Queries) -> DataFrame:
    """Exact scores of candidates, from their whole texts: ``item``, ``doc_id``, ``score``.

    The candidates are written first. Spark then knows their size before it plans the join, and moves no texts where they are few.
    """
    path = work_path(docs.sparkSession, "candidates")
    candidates.groupBy("doc_id", "text_key").agg(F.collect_set("item").alias("items")).write.parquet(path)
    wanted = docs.sparkSession.read.schema("doc_id bigint, text_key bigint, items array<bigint>").parquet(path)
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_key") == F.col("c.text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BREAKS)
        for batch in batches:
            for part in parts(batch, 16 << 20):
                words, bounds = hasher.words(part.column(1))
                rows = []
                for i, listed in enumerate(part.column(2).to_pylist()):
                    items = np.searchsorted(queries.items, np.array(sorted(listed), np.int64))
                    score = queries.scores(items, np.sort(words[bounds[i] : bounds[i + 1]]))
                    rows += [(int(queries.items[j]), part.column(0)[i].as_py(), int(s)) for j, s in zip(items, score, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], ["item", "doc_id", "score"])

    joined = docs.alias("d").join(wanted.alias("c"), same).select("d.doc_id", "d.text", "c.items")
    return joined.mapInArrow(run, "item bigint, doc_id bigint, score bigint").where("score > 0")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def weight(n_docs: int, df: Column) -> Column:
    return F.floor(F.lit(1000) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double"))).cast("bigint")


def _weighted(items: DataFrame, found: Index) -> DataFrame:
    """``item``, ``term`` and ``weight`` of the terms of items that some document holds; weights count repeats."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BREAKS)
        for batch in batches:
            for part in parts(batch):
                docs, terms, count = counted(*hasher.words(part.column(1)))
                numbers = part.column(0).to_numpy(zero_copy_only=False)[docs]
                yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(terms.view(np.int64)), pa.array(count.astype(np.int64))], ["item", "term", "count"])

    spark = items.sparkSession
    terms = items.select("item", "text").mapInArrow(split, "item bigint, term bigint, count bigint")
    asked = terms.select("term").distinct()
    held = found.read(spark).where("terms is not null").select(F.explode(F.arrays_zip("terms", "df")).alias("e")).select(F.col("e.terms").alias("term"), F.col("e.df").alias("df"))
    df = held.join(asked, "term").groupBy("term").agg(F.sum("df").alias("df"))
    return terms.join(df, "term").select("item", "term", (F.col("count") * weight(found.n_docs, F.col("df"))).alias("weight")).where("weight > 0")


def search(docs: DataFrame, items: DataFrame, k: int = 10, found: Index | None = None, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Each item's ``k`` highest-scoring documents with a score above 0: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Signatures of all documents (``index``; made here if not given) bound every score from above. The documents with the highest bounds are scored first;
    the ``k``-th best of these scores excludes all documents whose bound is below it, and all others are scored exactly, from their texts.

    Items are sent to the tasks in blocks of about 1 MB of text, a pass over the signatures for each. Every row of ``items`` is an
    item, also where ids repeat or are null; null texts find nothing. Equal scores go by smaller id, nulls last. Repeated documents are ranked
    one by one. Empty tables give no rows. Numbers are 64-bit: a score must stay below 2^63.
    """
    spark = docs.sparkSession
    found = found or index(docs, doc_id, text)
    path = work_path(spark, "items")
    numbered = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col("`text`").alias("text"))
    numbered.withColumn("item", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    path = work_path(spark, "terms")
    _weighted(numbered, found).write.parquet(path)
    terms = spark.read.parquet(path)
    size = numbered.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    count = int(size // QUERY_BYTES) + 1
    keyed = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_key"))
    blocks = found.read(spark).where("slices is not null").select("width", "doc_id", "text_key", "n", "levels", "slices")
    path = work_path(spark, "ranked")
    for block in range(count):
        rows = [tuple(r) for r in terms.where(F.pmod(F.xxhash64("item"), F.lit(count)) == block).select("item", "term", "weight").collect()]
        if not rows:
            continue
        queries = Queries(rows, found.n_docs, found.n_terms)
        order = Window.partitionBy("item").orderBy(F.desc("bound"), "doc_id", "text_key")
        best = _best_bounds(blocks, queries, k).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
        known = _ranked(_scored(keyed, best, queries), k).where(F.col("rank") == k)
        least = {row["item"]: row["score"] for row in known.select("item", "score").collect()}
        scores = _scored(keyed, _not_excluded(blocks, queries, least), queries)
        _ranked(scores, k).write.mode("append").parquet(path)
    ranked = scan(spark, path, "item bigint, doc_id bigint, score bigint, rank int")
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

