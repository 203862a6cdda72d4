"""Benchmark decontamination by spaced seeds: matches that tolerate substituted words."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeloom.llm.text import BASE, Hasher, parts, scrambled

#: Fixed masks: which of some neighbouring words are hashed. Wherever two of LEAST words are substituted, one mask fits beside them.
MASKS = ("11111011", "110101111", "111011101", "1101101011", "11110000111", "1111111", "1100110111")
SPAN, ALIKE = 13, 0.8
#: Items of fewer words are found whole, with all words equal.
LEAST = 11
#: Words are told apart by letters and digits alone, so that quotes, case and punctuation do not hide a passage.
BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())
#: Bytes of benchmark texts that are sent to the executors at a time.
BLOCK = 2 << 20


def seeds(words: np.ndarray, masks: tuple[str, ...] = MASKS) -> list[np.ndarray]:
    """For each mask, the hash of the words it keeps, at every position where it fits."""
    out = []
    for m, mask in enumerate(masks):
        n = max(0, len(words) - len(mask) + 1)
        total = np.full(n, m + 1, np.uint64)
        for k, keep in enumerate(mask):
            if keep == "1":
                total += words[k : k + n] * np.uint64(pow(BASE, k + 5, 2**64))
        out.append(scrambled(total))
    return out


class Index:
    """The seeds of one block of benchmark texts."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        self.ids = ids
        self.words, self.bounds = Hasher(BREAKS).words(pa.array(texts, pa.string()))
        hashes, items, places = [], [], []
        for i, (a, b) in enumerate(pairwise(self.bounds)):
            if b - a < LEAST:
                continue
            for hashed in seeds(self.words[a:b]):
                hashes.append(hashed)
                items.append(np.full(len(hashed), i))
                places.append(np.arange(len(hashed)))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.items = np.concatenate(items)[order] if hashes else np.empty(0, np.int64)
        self.places = np.concatenate(places)[order] if hashes else np.empty(0, np.int64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> np.uint64(44)] = True
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, (a, b) in enumerate(pairwise(self.bounds)):
            if 0 < b - a < LEAST:
                self.short.setdefault(int(b - a), {}).setdefault(int(seeds(self.words[a:b], ("1" * (b - a),))[0][0]), []).append(i)

    def overlaps(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """Each text and item that share a passage: text, item, first word in the text, first word in the item, length, equal words.

        The texts' words stand one after the other. Seeds that reach over the end of a text can only give hits that fail the comparison.
        """
        found = set()
        for hashed in seeds(words):
            at = np.flatnonzero(self.seen[hashed >> np.uint64(44)])
            low, high = np.searchsorted(self.hashes, hashed[at], "left"), np.searchsorted(self.hashes, hashed[at], "right")
            hit = high > low
            docs = np.searchsorted(bounds, at[hit], "right") - 1
            for doc, p, a, b in zip(docs.tolist(), at[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
                found.update((doc, int(self.items[k]), p - int(bounds[doc]) - int(self.places[k])) for k in range(a, b))
        best = {}
        for doc, item, shift in found:
            span = self._verified(words[bounds[doc] : bounds[doc + 1]], item, shift)
            if span and span[::-1] > best.get((doc, item), ())[::-1]:
                best[doc, item] = span
        best |= self._whole(words, bounds)
        return [(*pair, *span) for pair, span in sorted(best.items())]

    def _whole(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """The first place of each short item in each text."""
        best = {}
        for n, known in self.short.items():
            hashed = seeds(words, ("1" * n,))[0]
            at = np.flatnonzero(np.isin(hashed, np.fromiter(known, np.uint64, len(known))))
            docs = np.searchsorted(bounds, at, "right") - 1
            inside = at + n <= bounds[docs + 1]
            at, docs = at[inside], docs[inside]
            _, first = np.unique(np.stack([docs.astype(np.uint64), hashed[at]]), axis=1, return_index=True)
            for p, doc in zip(at[first].tolist(), docs[first].tolist(), strict=True):
                for item in known[int(hashed[p])]:
                    best[doc, item] = p - int(bounds[doc]), 0, n, n
        return best

    def _verified(self, words: np.ndarray, item: int, shift: int) -> tuple[int, int, int, int] | None:
        """The span on a diagonal that is covered by windows of SPAN words of which ALIKE are equal."""
        test = self.words[self.bounds[item] : self.bounds[item + 1]]
        first, last = max(0, -shift), min(len(test), len(words) - shift)
        need = min(SPAN, len(test))
        if last - first < need:
            return None
        same = test[first:last] == words[first + shift : last + shift]
        count = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(count[need:] - count[:-need] >= ALIKE * need)
        if not len(good):
            return None
        a, b = int(good[0]), int(good[-1]) + need
        return first + shift + a, first + a, b - a, int(count[b] - count[a])


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark in blocks of bounded size, one on the driver at a time; ids in order, null and wordless items left out."""
    items = benchmark.select("item_id", "text").where("text is not null and item_id is not null")
    size = items.agg(F.sum(F.length("text"))).head()[0] or 0
    count = -(-size * 2 // BLOCK) or 1
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield Index([row["item_id"] for row in rows], [row["text"] for row in rows])


FOUND = "doc_id bigint, item_id bigint, doc_word bigint, item_word bigint, length bigint, equal bigint"


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Passages of benchmark items in documents: the longest for each pair of ``doc_id`` and ``item_id``.

    Fixed masks ignore some of the neighbouring words, so a hash of the rest also matches where those were substituted; any two
    substitutions in eleven words leave a mask that matches. All positions of all whole texts are looked up; around a hit, the two texts are compared word by word along its diagonal. A pair counts if
    13 words in a row (or an item of 11 or 12 words whole) have 80 % equal. ``doc_word``, ``item_word``: where the span starts;
    ``length``: its words; ``equal``: those alike. A benchmark of any size is looked up in blocks.

    An item of fewer than eleven words is found where all of it stands. Null texts, and items without an id, have no overlaps. Repeated documents repeat their rows, repeated items count once.
    """
    found = None
    for index in _blocks(benchmark):

        def look(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            hasher = Hasher(BREAKS)
            for batch in batches:
                for part in parts(batch):
                    words, bounds = hasher.words(part.column(1))
                    rows = [(part.column(0)[doc].as_py(), index.ids[item], *span) for doc, item, *span in index.overlaps(words, bounds)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], FOUND.replace(" bigint", "").split(", "))

        some = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(look, FOUND)
        found = some if found is None else found.unionByName(some)
    return docs.sparkSession.createDataFrame([], FOUND) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any overlap, all their columns; nothing is shuffled. Items without an id are left out."""
    for index in _blocks(benchmark):
        at = docs.columns.index("text")

        def keep(batches: Iterator[pa.RecordBatch], index: Index = index, at: int = at) -> Iterator[pa.RecordBatch]:
            hasher = Hasher(BREAKS)
            for batch in batches:
                for part in parts(batch):
                    words, bounds = hasher.words(part.column(at))
                    kept = np.ones(part.num_rows, bool)
                    kept[[doc for doc, *_ in index.overlaps(words, bounds)]] = False
                    yield part.filter(pa.array(kept))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
