from __future__ import annotations

import math
import re
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changeloom.llm import chat, decontam, language, license_scan, mtree, pii, pitman_yor

from .conftest import words


def test_chat_reads_back(spark):
    odd = ["\\", "### x:\n", "</turn>\n", "\\### Assistant: </turn> ok", "a\\\\#<:b\n\n", "", None, "é\U0001f600"]
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(zip(["user", "assistant", None, "a:\\b"] * 2, odd, strict=True))]
    frame = spark.createDataFrame([*rows, (None, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_trees(chat.chains(frame, "conv_id", ["turn", "role", "text"])).collect()
    assert len(formatted) == 4
    for row in formatted:
        if row["tree"] != "null":
            turns = [(r or "", x or "") for c, _, r, x in rows if c == int(row["tree"])]
            assert chat.parse(row["formatted"]) == turns
            learned = [chat.unescaped(row["formatted"][s.start : s.stop]) for s in row["loss"]]
            assert learned == [x for r, x in turns if r == "assistant"]
    assert chat.format_trees(chat.chains(frame.limit(0), "conv_id", ["turn", "role", "text"])).count() == 0


def test_branches(spark):
    nodes = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 1.0), ("t", 4, 3, 9.0), ("t", 4, 3, 9.0), ("t", 5, 99, 0.0), ("c", 1, 2, 1.0), ("c", 2, 1, 1.0)]
    nodes += [("long", i, i - 1 if i else None, None) for i in range(70)]
    found = chat.branches(spark.createDataFrame(nodes, "tree string, node bigint, parent bigint, score double"), best=2)
    paths = {}
    for r in found.collect():
        paths.setdefault((r["tree"], r["rank"]), {})[r["depth"]] = r["node"]
    assert paths["t", 1] == {1: 1, 2: 3, 3: 4} and paths["t", 2] == {1: 1, 2: 2}
    assert paths["long", 1] == {i + 1: i for i in range(70)} and not any(tree == "c" for tree, _ in paths)


def test_pseudonyms(spark):
    texts = [
        "mail jo.smith7@mail.example.com, call +1 (803) 555-5351!", "card 4111111111111111 not 4111111111111112", "4111 1111 1111 1111 on 2021-03-04",
        "ip 10.0.0.255 not 10.0.0.256, ssn 123-45-6789 not 000-12-3456", "jo.smith7@mail.example.com 31/12/1999 03.04.2021 2021-13-45", "nothing 1.5 or 42", None, "",
    ]
    frame = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, found int")
    rows = {r["doc_id"]: r for r in pii.pseudonymize(frame, "k").collect()}
    kinds = lambda i: [m["kind"] for m in rows[i]["found"]]
    assert kinds(0) == ["email", "phone"] and kinds(1) == ["card"] and kinds(2) == ["card", "date"] and kinds(3) == ["ip", "ssn"]
    assert kinds(4) == ["email", "date", "date"] and all(rows[i]["text"] == texts[i] and not rows[i]["found"] for i in (5, 6, 7))
    assert rows[0]["found"][0]["pseudonym"] == rows[4]["found"][0]["pseudonym"]
    for row in rows.values():
        text = texts[row["doc_id"]]
        for m in row["found"]:
            assert m["value"] != m["pseudonym"] and len(m["pseudonym"]) == len(m["value"]) or m["kind"] == "ip"
            assert re.sub(r"[0-9]", "9", re.sub("[a-z]", "a", m["pseudonym"])) == re.sub(r"[0-9]", "9", re.sub("[a-z]", "a", m["value"])) or m["kind"] in ("ip", "email")
            text = text.replace(m["value"], m["pseudonym"], 1)
        assert text == row["text"]
    again = pii.pseudonymize(spark.createDataFrame([(0, rows[1]["text"], 0)], frame.schema), "k").collect()[0]
    assert [m["kind"] for m in again["found"]] == ["card"]  # still a valid number


def test_permutation_of_pseudonyms(spark):
    frame = spark.range(10_000).select(pii._digits(F.lpad(F.col("id").cast("string"), 4, "0"), "card", "k").alias("x"))
    assert frame.distinct().count() == 10_000 and frame.where("length(x) <> 4").count() == 0


def test_licenses_equal_brute_force(spark):
    texts = [
        "Under the GNU General Public License and the gnu general  public license.", "Apache License, cc-by MIT License MIT license", "mit licence", None, "", "mit",
        "This work is licensed under the GNU General Public Licence, version 3", "x cc by cc by cc", "released under MIT license", "ünder cc bÿ",
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[1]])], "doc_id bigint, text string")
    for r in license_scan.summarize(frame).collect():
        text = [*texts, texts[1]][r["doc_id"]]
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        places = sorted((i, label) for label, p in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places})) and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert license_scan.summarize(frame).where("doc_id = 6").head()["labels"] == "gpl"
    assert license_scan.summarize(frame.limit(0)).count() == 0


def test_language(spark, docs):
    folder = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.fit(folder.where(~fold))
    held = language.identify(folder.where(fold), model)
    assert held.where("lang_pred = lang").count() >= 0.98 * held.count()
    odd = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert all((odd[i]["lang_pred"], odd[i]["score"]) == ("und", 0.0) for i in (4, 5, 6)) and 0 <= odd[1]["score"] <= 1
    nothing = language.fit(folder.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def test_small_languages_are_learned(spark):
    big = [(i, " ".join(f"{a}{b}o" for a in "bcdfg" for b in "aeiu"), "aa") for i in range(400)]
    late = [(1000 + i, f"\u0436\u0434{chr(0x430 + i)}\u0449 \u0448{chr(0x430 + i)}\u044e", "zz") for i in range(5)]
    model = language.fit(spark.createDataFrame([*big, *late], "doc_id bigint, text string, lang string"), 50)
    assert model.languages == ["aa", "zz"] and all(model.knows(word) for _, text, _ in late for word in text.split())
    assert model.predict("\u0436\u0434\u044e\u0449 \u0448\u0449\u044e")[0] == "zz" and model.predict("\u0448\u0430\u044e")[1] > 0.9
    small = language.fit(spark.createDataFrame([(1, "ab ab cd", "aa"), (2, "xy", "zz")], "doc_id bigint, text string, lang string"), 50)
    assert all(small.knows(word) for word in ("ab", "cd", "xy")) and not small.knows("ac")
    assert all(small._found(1, list("abcdxy"))[1]) and all(small._found(4, [" ab ", " xy "])[1])


def test_rows_without_ids_are_sampled_like_others(spark):
    rows = [(None, f"word{i} other{chr(97 + i % 26)}", "aa") for i in range(1000)]
    known = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(known, 50)
    assert 20 < sum(model.knows(f"other{chr(97 + i % 26)}") for i in range(26)) + len(model.hashes[0]) < 120


def plain_prediction(model_rows, languages, text):
    """The same model with plain dictionaries."""
    scores = dict.fromkeys(languages, 0.0)
    found = language.WORD.findall(text.lower())
    for word in found:
        parts = [(0, word)] if (0, word) in model_rows else []
        for n in range(language.LONGEST, 0, -1):
            parts = parts or [(n, run) for run in language.runs(word, n) if (n, run) in model_rows]
        for lang in languages:
            scores[lang] += sum(model_rows[p][lang] for p in parts) / max(1, len(parts))
    return {lang: score * min(1.0, language.EVIDENCE / max(1, len(found))) for lang, score in scores.items()}


def test_language_equals_plain_model(spark):
    docs = [(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, "le chien et le chat the", "fr"), (4, "los perros", "es")]
    model = language.fit(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    counts = {}
    for _, text, lang in docs:
        for word in text.split():
            for part in [(0, word), *((n, run) for n in range(1, 6) for run in language.runs(word, n))]:
                counts.setdefault(part, Counter())[lang] += 1
    languages = ["de", "en", "es", "fr"]
    totals = {(kind, lang): sum(c[lang] + 0.5 for (k, _), c in counts.items() if k == kind) for kind in range(6) for lang in languages}
    logs = {part: {lang: math.log((c[lang] + 0.5) / totals[part[0], lang]) for lang in languages} for part, c in counts.items()}
    rows = {part: {lang: value - max(by.values()) for lang, value in by.items()} for part, by in logs.items()}
    for text in ["the hound", "katzen und hunde", "chat", "perro perro los", "xqz", "the " * 50 + "und", "CHIENS, dogs!", "zz\u0436"]:
        scores = plain_prediction(rows, languages, text)
        best = max(languages, key=lambda lang: scores[lang])
        share = 1 / sum(math.exp(s - scores[best]) for s in scores.values())
        assert model.predict(text) == (best, pytest.approx(share, abs=1e-4)), text
    tie = language.fit(spark.createDataFrame([(1, "aa", "x"), (2, "aa", "y")], "doc_id bigint, text string, lang string"))
    assert tie.predict("aa") == ("x", 0.5)


def test_language_is_predicted_once(spark, docs):
    frame = docs.drop("shard").selectExpr("*", "1L as n_chars", "'x' as lang_pred", "2.0 as SCORE")
    plan = corpus_pipeline.identify_language(spark, frame, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    model = language.fit(docs)
    found = language.identify(frame, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"] and found.count() == docs.count()
    assert language.identify(frame.limit(0), model).count() == 0


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 700)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, 6)) * rng.lognormal(size=(1500, 1))
    base[200:400] = base[7]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)] + [(2000, None), (2001, [None, 1.0]), (2002, [float("nan")] * 6), (2003, []), (2004, [1.0, 2.0])]
    frame = spark.createDataFrame([*rows, rows[0]], "vec_id bigint, embedding array<double>").select("vec_id", mtree.quantized(F.col("embedding")).alias("vector"))
    found = {}
    for r in mtree.top_k(frame, frame.where("vec_id % 100 = 0"), 10).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    v = np.floor(base * 1024).astype(int)
    for q in range(0, 1500, 100):
        score = v @ v[q]
        best = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:10]
        assert sorted(found[q]) == [(k + 1, int(i), int(score[i])) for k, i in enumerate(best)]
    assert set(found) == set(range(0, 1500, 100))
    tree = mtree.MTree(np.arange(1500), v.astype(float))
    tree.search(7, v[7].astype(float), 10)
    assert tree.computed < 1500


def test_decontamination(spark):
    item = [f"q{i}" for i in range(30)]
    changed = list(item)
    changed[9] = changed[21] = "z"
    other = " ".join(f"o{i}" for i in range(200))
    texts = [f"{other} {' '.join(item)} {other}", f"{other} {' '.join(changed).upper()}.", other, " ".join(item[:9]), None, "", f"{other} {' '.join(item[4:22])}"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "short one"), (None, other)], "item_id bigint, text string")
    found = {r["doc_id"]: r for r in decontam.overlaps(docs, bench).collect()}
    assert set(found) == {0, 1, 6} and found[0]["length"] == found[0]["equal"] == 30 and found[1]["equal"] == 28 and found[0]["doc_word"] == 200
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [2, 3, 4, 5] and decontam.clean(docs, bench).columns == docs.columns
    assert decontam.overlaps(docs, bench.limit(0)).count() == 0 and decontam.clean(docs.limit(0), bench).count() == 0


def test_decontamination_covers_substitutions_and_short_items(spark):
    for n in (11, 12, 13):
        index = decontam.Index([7], [" ".join(f"q{i}" for i in range(n))])
        texts = [" ".join("z" if i in pair else f"q{i}" for i in range(n)) for pair in combinations_with_replacement(range(n), 2)]
        words_, bounds = decontam.Hasher(decontam.BREAKS).words(pa.array(texts))
        assert {doc for doc, *_ in index.overlaps(words_, bounds)} == set(range(len(texts)))
    texts = ["so a short item it is", "so a short", "item it is", "a Short, item", "a short thing item", "yes", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a short item"), (2, "A short item!"), (None, "yes"), (3, ""), (4, "is it so")], "item_id bigint, text string")
    found = sorted((r["doc_id"], r["item_id"], r["doc_word"], r["item_word"], r["length"], r["equal"]) for r in decontam.overlaps(docs, bench).collect())
    assert found == [(0, 1, 1, 0, 3, 3), (0, 2, 1, 0, 3, 3), (3, 1, 0, 0, 3, 3), (3, 2, 0, 0, 3, 3)]
    assert sorted(r["doc_id"] for r in decontam.clean(docs, corpus_pipeline.numbered(bench)).collect()) == [1, 2, 4, 6]


def test_scores(spark, docs):
    learn = F.col("doc_id") % 4 != 3
    rows = pitman_yor.score(docs, learn).collect()
    given = [(r["doc_id"], [*words(r["text"]), None]) for r in docs.collect()]
    counts = Counter(w for i, ws in given if i is not None and i % 4 != 3 for w in ws)
    total, size = sum(counts.values()), len(counts)
    plain = sorted((i or -1, len(ws), sum(counts[w] > 0 for w in ws), round(sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in ws), 4)) for i, ws in given)
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == plain
    assert {r["train_tokens"] for r in rows} == {total} and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert pitman_yor.score(docs.limit(0), learn).count() == 0


def test_spelling_is_a_distribution():
    data = np.frombuffer(b"banana bandana nab ban", np.uint8)
    starts, ends = np.array([0, 7, 15, 19]), np.array([6, 14, 18, 22])
    keys, counts = np.unique(pitman_yor.spelled(data, starts, ends)[0], return_counts=True)
    levels = pitman_yor.sampled(keys, counts.astype(np.int64), 1)
    model = pitman_yor.Model(np.empty(0, np.uint64), np.zeros(1, np.int64), np.zeros(1), np.zeros(pitman_yor.SMALL), 1.0, 10, levels)
    for context in (0x2020202020, 0x2020206261, 0x7A7A7A7A7A):
        every = np.array([(context << 8) | b for b in range(256)], np.uint64)
        assert (10 ** model.spelling(every)).sum() == pytest.approx(1.0, abs=0.35)


