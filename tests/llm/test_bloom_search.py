from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm import bloom_search as bs
from changeloom.llm.text import Hasher

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Every item against every document, in plain Python."""
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for doc, count in counts:
            m = 25 + 75 * sum(count.values()) * n_docs // max(1, n_terms)
            score = 0
            for t in terms(text):
                if count[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        found += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(found, key=repr)


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Straße", "ÉCLAIR", "x_y", "don't", "日本"]
    docs = [(i, " ".join(rng.choices(words, k=int(rng.paretovariate(0.7)) % 3000))) for i in range(n)]
    docs += [(1000 + i % 3, docs[5][1] + " alpha beta gamma") for i in range(30)]  # copies, with repeated ids
    docs += [(None, "alpha beta"), (None, "alpha beta"), (2000, None), (2001, ""), (2002, " ?! "), (2003, "ALPHA " * 5000 + "beta"), (2004, "rare " + "w1 " * 20_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(25)]
    return docs, [*items, (50, "alpha beta Gamma alpha"), (50, "alpha"), (None, "rare unknown"), (51, "unknown"), (52, None), (53, ""), (54, "w1 " * 50)]


def frames(spark, docs, items, parts=4):
    left = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, rank int, item string").repartition(parts)
    return left, spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, score int")


def test_equals_brute_force(spark):
    docs, items = corpus()
    for k in (1, 10):
        found = bs.search(*frames(spark, docs, items), k)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items, k)


def test_queries_in_blocks(spark, monkeypatch):
    docs, items = corpus(2, 100)
    monkeypatch.setattr(bs, "QUERY_BYTES", 300)
    found = bs.search(*frames(spark, docs, items), 10)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items, 10)


def test_empty_tables(spark):
    docs, items = corpus(3, 20)
    left, right = frames(spark, docs, items)
    assert bs.search(left.limit(0), right).count() == 0 and bs.search(left, right.limit(0)).count() == 0
    assert bs.search(left.where("text is null"), right).count() == 0


@pytest.fixture(scope="module")
def built():
    """Blocks and queries over one corpus, made without Spark."""
    docs, items = corpus(4, 600)
    hasher = Hasher(bs.BREAKS)
    words, bounds = hasher.words(pa.array([t for _, t in docs]))
    lengths = np.diff(bounds)
    blocks = list(bs._signatures(*bs.counted(words, bounds), list(range(len(docs))), [0] * len(docs), lengths))
    n_docs, n_terms = int((lengths > 0).sum()), int(lengths.sum())
    rows = []
    for i, (_, text) in enumerate(items):
        for t, c in Counter(terms(text)).items():
            h = int(hasher.words(pa.array([t]))[0].view(np.int64)[0])
            rows.append((i, h, c * 700))
    return words, bounds, blocks, bs.Queries(rows, n_docs, n_terms)


def test_bounds_hold_and_exclude(built):
    words, bounds, blocks, queries = built
    excluded = checked = 0
    every = np.arange(len(queries.items))
    best = np.zeros((len(every), 0), np.int64)
    pairs = []
    for block in blocks:
        bound = queries.bounds_of(block)
        exact = np.stack([queries.scores(every, np.sort(words[bounds[d] : bounds[d + 1]])) for d in block["doc_id"]], axis=1)
        assert (bound >= exact).all()
        pairs.append((bound, exact))
    bound, exact = (np.concatenate(x, axis=1) for x in zip(*pairs, strict=True))
    tenth = -np.sort(-exact, axis=1)[:, 9]
    checked, excluded = bound.size, int((bound < np.maximum(tenth, 1)[:, None]).sum())
    assert excluded > 0.8 * checked and best.size == 0


def test_slices_overestimate(built):
    words, bounds, blocks, _ = built
    for block in blocks:
        slices = np.unpackbits(np.frombuffer(block["slices"], np.uint8).reshape(block["width"], -1), axis=1)
        for column, doc in enumerate(block["doc_id"][:20]):
            found, count = np.unique(words[bounds[doc] : bounds[doc + 1]], return_counts=True)
            for level, least in enumerate(bs.LEVELS):
                for place in bs.places(found[count >= least], level, block["width"]):
                    assert slices[place, column].all()
