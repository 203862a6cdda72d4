"""Language identification: words first, then ever shorter runs of letters for words not seen before."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from changeloom.llm.text import parts
from changeloom.session import work_path

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
LONGEST = 5
#: Bound of what is learned from: labelled rows, dealt out to the languages.
SAMPLE_ROWS = 8_000
#: A text counts as at most so many words of evidence, so that the score of a long one in two languages stays below 1.
EVIDENCE = 20.0


def hashed(kind: int, text: str) -> int:
    """The hash of a word (kind 0) or of a run of so many letters, as Spark's ``xxhash64`` makes it."""
    return xxhash.xxh64_intdigest(f"{kind}{text}", 42)


class Model:
    """Log frequencies of words and of letter runs by language: sorted hashes of each kind, and a row of one matrix for each of them."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """``counts``: for words and for runs of each length, the hash, the place of the language, and the number of occurrences."""
        self.languages = languages
        self.hashes, self.rows = [], []
        for hashes, langs, numbers in counts:
            values, at = np.unique(hashes, return_inverse=True)
            sums = np.zeros((len(values), len(languages)))
            np.add.at(sums, (at, langs), numbers)
            self.hashes.append(values)
            self.rows.append(self._logs(sums).astype(np.float32))

    @staticmethod
    def _logs(counts: np.ndarray) -> np.ndarray:
        if not counts.size:
            return counts
        rows = np.log((counts + 0.5) / (counts + 0.5).sum(axis=0))
        return rows - rows.max(axis=1, keepdims=True)

    def knows(self, word: str) -> bool:
        return bool(self._found(0, [word])[1][0])

    def _found(self, kind: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The row of each text of a kind, and whether there is one."""
        wanted = np.fromiter((hashed(kind, text) for text in texts), np.uint64, len(texts))
        known = self.hashes[kind]
        if not len(known):
            return np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return at, known[at] == wanted

    def predict(self, text: str | None) -> tuple[str, float]:
        """A known word is scored by its own row, another one by the mean of the rows of its longest runs of letters that are known."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        counted = Counter(WORD.findall(text.lower()))
        words, counts = list(counted), np.fromiter(counted.values(), np.float64, len(counted))
        at, found = self._found(0, words)
        total = counts[found] @ self.rows[0][at[found]]
        rest = np.flatnonzero(~found)
        for n in range(LONGEST, 0, -1):
            if not len(rest):
                break
            listed = [runs(words[i], n) for i in rest]
            owner = np.repeat(rest, [len(some) for some in listed])
            at, found = self._found(n, [run for some in listed for run in some])
            owner, at = owner[found], at[found]
            known = np.bincount(owner, minlength=len(words))
            total = total + (counts[owner] / known[owner]) @ self.rows[n][at]
            rest = rest[known[rest] == 0]
        total = total * min(1.0, EVIDENCE / max(1.0, counts.sum()))
        share = np.exp(total - total.max())
        best = int(np.argmax(share))
        return self.languages[best], float(share[best] / share.sum())


def runs(word: str, n: int) -> list[str]:
    """The runs of n letters of a word, whose ends count as blanks for n > 1."""
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model of about ``rows`` of the rows with ``text`` and ``lang``, chosen by a hash of the whole row.

    Languages have equal shares of the rows; what a small one leaves over goes to the others. Equal rows are chosen together or not at all, rows
    without ``doc_id`` like others. All words of the chosen rows are learned, and all runs of letters of these. They are counted in
    Spark; the driver gets 64-bit hashes and numbers. Null texts and languages teach nothing. Without labelled rows every
    prediction is ``und``.
    """
    spark = labelled.sparkSession
    known = labelled.where("text is not null and lang is not null")
    shares = _shares([tuple(row) for row in known.groupBy("lang").count().collect()], rows)
    languages = sorted(lang for lang, _ in shares)
    if not shares:
        return Model([], [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))] * (LONGEST + 1))
    # Looked up in a map of one entry for each language: a join would move the texts by language, of which there are few.
    share = F.create_map(*[F.lit(x) for lang, part in shares for x in (lang, part)])[F.col("lang")]
    place = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])[F.col("lang")]
    sample = known.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**30)) < share).select("text", place.alias("place"))
    words = sample.select("place", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    path = work_path(spark, "words")
    words.groupBy("place", "word").count().write.parquet(path)
    counted = spark.read.parquet(path)
    kinds = [counted.select("place", F.lit(0).alias("kind"), F.col("word").alias("part"), "count")]
    for n in range(1, LONGEST + 1):
        padded = F.concat(F.lit(" "), "word", F.lit(" ")) if n > 1 else F.col("word")
        long_enough = counted.select("place", "count", padded.alias("padded")).where(F.length("padded") >= n)
        each = F.explode(F.regexp_extract_all("padded", F.lit(f"(?=(.{{{n}}}))"), 1))  # linear in the word's length, as a substring for each place is not
        kinds.append(long_enough.select("place", F.lit(n).alias("kind"), each.alias("part"), "count"))
    path = work_path(spark, "runs")
    for some in kinds:
        hashes = some.select("place", "kind", F.xxhash64(F.concat(F.col("kind").cast("string"), "part")).alias("hash"), "count")
        hashes.groupBy("place", "kind", "hash").agg(F.sum("count").alias("count")).write.mode("append").parquet(path)
    summed = spark.read.parquet(path)

    def numbers(kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = summed.where(F.col("kind") == kind).select("hash", "place", "count").toArrow()
        hashes, places, counts = (column.to_numpy() for column in table.columns)
        return hashes.astype(np.int64).view(np.uint64), places, counts

    return Model(languages, [numbers(kind) for kind in range(LONGEST + 1)])


def _shares(sizes: list[tuple[str, int]], rows: int) -> list[tuple[str, int]]:
    """The part of each language's rows to learn from, in 2^30ths."""
    shares = []
    for i, (lang, n) in enumerate(sorted(sizes, key=lambda x: (x[1], x[0]))):
        quota = min(n, rows / (len(sizes) - i))
        rows -= quota
        shares.append((lang, int(2**30 * quota / n)))
    return shares


def identify(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """The input's columns, then the predicted language and its share of the likelihood, from ``text`` alone.

    Whole texts are read, each once, whatever is done with the result. Text that is null or has no letter is ``und`` with score 0; ties go to the
    language first in order. Columns named like the results are replaced; repeated rows and extra columns stay.
    """
    kept = [f for f in docs.schema.fields if f.name.lower() not in (lang, score)]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 16 << 20):
                found = [model.predict(text) for text in part.column(part.schema.get_field_index("text")).to_pylist()]
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                results = [pa.array([name for name, _ in found], pa.string()), pa.array([share for _, share in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*columns, *results], [*[f.name for f in kept], lang, score])

    return docs.mapInArrow(predict, StructType([*kept, StructField(lang, StringType()), StructField(score, DoubleType())]))
