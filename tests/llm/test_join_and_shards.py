from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from changeloom.llm import jaccard_join, mixing, sharding
from changeloom.llm.components import components
from changeloom.llm.text import Hasher, shingles

from .conftest import words


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingle_set(t) for i, t in rows}
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_hashes_tell_words_apart():
    texts = ["Über den  Wolken", None, "", "a\tB a b", "x" * 3_000_000, "ab", "a b"]
    hashes, bounds = Hasher().words(pa.array(texts))
    plain = [w for t in texts for w in words(t)]
    assert np.diff(bounds).tolist() == [len(words(t)) for t in texts]
    assert len(set(zip(plain, hashes.tolist(), strict=True))) == len(set(plain)) == len(set(hashes.tolist()))
    assert np.diff(shingles(hashes, bounds, 5)[1]).tolist() == [1, 0, 0, 1, 1, 1, 1]


@pytest.mark.parametrize("small", [False, True])
def test_join_equals_brute_force(spark, docs, small, monkeypatch):
    if small:
        for name, value in (("REGION_SETS", 2), ("PIVOTS", 2), ("SEEKERS", 1), ("DEPTH", 2)):
            monkeypatch.setattr(jaccard_join, name, value)
    rng = np.random.default_rng(5)
    base = [f"v{i}" for i in range(60)]
    more = []
    for i in range(25):
        w = list(base)
        for at in rng.integers(0, 60, 1 + i % 4):
            w[at] = f"n{rng.integers(0, 9)}"
        more.append((100 + i, " ".join(w)))
    given = docs.where("doc_id is not null").select("doc_id", "text").distinct().unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    expected = classes([tuple(r) for r in given.collect()])
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(given).collect()}
    assert found == expected


def test_pivots_of_a_large_region_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REGION_SHINGLES", 1)
    # Of each pair, the pivot is the smaller or the larger document.
    texts = [[f"p{i}w{k}" for k in range(40)] for i in range(12)]
    rows = [(10 * i + k, " ".join([*t, "x"][: 40 + k])) for i, t in enumerate(texts) for k in (0, 1)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == classes(rows)


def test_rows_sent_to_the_driver_do_not_grow(spark, monkeypatch):
    sent = []
    for name in ("collect", "toPandas"):
        given = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, given=given: (sent.append(len(out := given(self))), out)[1])
    pairs = [(2 * i + k, " ".join(f"w{i}x{j if j < 39 else j + k}" for j in range(40))) for i in range(200) for k in range(2)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string").repartition(4)
    found = jaccard_join.join(docs)
    most = max(sent)
    assert found.where("component_id = doc_id - doc_id % 2").count() == 400 and most <= 64


@pytest.mark.parametrize("slots", [[], [0, 1, 7, 8, 32767, 32768, 32768, (1 << 21) - 1]])
def test_bits_of_slots(spark, slots):
    packed = jaccard_join._bits(spark.createDataFrame([(x,) for x in slots], "slot bigint"))
    assert np.flatnonzero(np.unpackbits(packed, bitorder="little")).tolist() == sorted(set(slots))


def test_join_of_odd_rows(spark, docs):
    rows = jaccard_join.join(docs).collect()
    assert len(rows) == docs.count()
    assert [r.component_id for r in rows if r.doc_id is None] == [1]
    assert [r.component_id for r in rows if r.doc_id == 9] == [9, 9]
    assert jaccard_join.join(docs.limit(0)).count() == 0
    kept = jaccard_join.keep_one(docs).select("doc_id").collect()
    assert sorted(r[0] for r in kept if r[0] is not None) == [1, 4, 5, 6, 7, 9, 9, 11]


def test_one_row_of_each_class(spark, docs):
    far = docs.where("doc_id = 9").head()["text"]
    late = " ".join(f"z{i}" for i in range(100))
    rows = [(9, late, "en", "a", 1), (20, f"{late} x", "en", "b", 2), (None, late, "en", "c", 3), (1, far, "en", "d", 4)]
    rows += [(None, "only here without a number", "en", "e", 5)] * 2
    given = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = jaccard_join.one_of_each(given)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted(r["doc_id"] or 0 for r in found) == [0, 1, 1, 4, 5, 6, 7, 9, 11]
    assert {r["text"] for r in found if r["doc_id"] in (None, 9)} == {late, "only here without a number"}
    assert len({r["text"] for r in found}) == len(found)
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (50, 50)] + [(200, i) for i in range(201, 230)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0} and found[101] == 100 and found[50] == 50 and found[229] == 200
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 100, 4097])
def test_permutation(n):
    p = sharding.Permutation(n, 7)
    x = np.arange(n)
    assert sorted(p.forward(x)) == list(range(n)) and (p.inverse(p.forward(x)) == x).all()


def test_shards(spark, docs):
    rows = sharding.shard(docs, 4, ["doc_id", "text"]).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(r["position"] for r in rows) == list(range(docs.count()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard(docs.repartition(5), 4, ["doc_id", "text"]).collect()
    key = lambda r: (r["doc_id"] or 0, r["text"] or "", r["position"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert sharding.shard(docs.limit(0), 4, ["doc_id"]).count() == 0


def test_mix(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["copies"] <= 2 for r in rows)
    by_source = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    total = sum(s for s, _ in by_source.values())
    assert sum(t for _, t in by_source.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s for s, t in by_source.values())
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in rows) and mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), (F.col("id") * 7919 % 500).alias("n")
    )
    rows = mixing.mix(docs, size=F.col("n")).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.01 * r["target"] for r in rows)
