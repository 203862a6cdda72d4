"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20  # bytes hashed at a time
BASE = 0x9E3779B97F4A7C15 | 1
BLANKS = bytes([0x20, *range(0x09, 0x0E)])


def scrambled(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes the words of texts: runs of bytes other than ``breaks``, A-Z as a-z."""

    def __init__(self, breaks: bytes = BLANKS):
        self.is_break = np.zeros(256, bool)
        self.is_break[list(breaks)] = True
        lower = np.arange(256, dtype=np.uint64)
        lower[65:91] += np.uint64(32)
        self.value = scrambled(lower + np.uint64(0x1234567))
        self.up, self.down = _powers(BASE, WINDOW), _powers(pow(BASE, -1, 2**64), WINDOW)

    def spans(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts, where each word begins and ends in them, and each text's first word (n + 1 bounds)."""
        offsets, data = _buffers(texts)
        n = len(texts)
        if not len(data):
            return data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n + 1, np.int64)
        apart = np.zeros(len(data) + 1, bool)
        apart[offsets] = True
        breaks = self.is_break[data]
        word = ~breaks
        starts = word.copy()
        starts[1:] &= breaks[:-1] | apart[1:-1]
        ends = word
        ends[:-1] &= breaks[1:] | apart[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return data, starts, ends, np.searchsorted(starts, offsets).astype(np.int64)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in order, and each text's first word (n + 1 bounds)."""
        data, starts, ends, bounds = self.spans(texts)
        return self.hashed(data, starts, ends), bounds

    def hashed(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            last = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW, "right")))
            low, high = starts[at], ends[last - 1]
            if high - low > len(self.up):
                self.up, self.down = _powers(BASE, high - low), _powers(pow(BASE, -1, 2**64), high - low)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self.value[data[low:high]] * self.up[: high - low], out=total[1:])
            a, b = starts[at:last] - low, ends[at:last] - low
            hashes[at:last] = (total[b] - total[a]) * self.down[a] + (b - a).astype(np.uint64)
            at = last
        return scrambled(hashes)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and the UTF-8 bytes of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]


def parts(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``limit`` bytes of its rows, one row at least."""
    if not batch.num_rows:
        return
    step = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words, in order, with bounds as for the words.

    A text of fewer words has one run, all its words; one without words has none.
    """
    lengths = np.diff(bounds)
    n = len(words)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed[: max(0, n - k)] += words[k:] * np.uint64(pow(BASE, k + 3, 2**64))
    left = np.repeat(bounds[1:], lengths) - np.arange(n)
    kept = left >= size
    for i in np.flatnonzero((lengths > 0) & (lengths < size)):
        some = words[bounds[i] : bounds[i + 1]]
        mixed[bounds[i]] = np.sum(some * _powers(BASE, size + len(some) + 3)[-len(some) :]) + np.uint64(len(some))
        kept[bounds[i]] = True
    counts = np.zeros(len(bounds), np.int64)
    counts[1:] = np.cumsum(np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64)))
    return scrambled(mixed[kept]), counts
