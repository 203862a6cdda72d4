from __future__ import annotations

import hashlib
import random
from itertools import pairwise

import pytest
from compare import difference

import duckdb
from changeloom.llm import dialog_repair as dr
from changeloom.llm import queries as llm_queries
from changeloom.llm.oracles import oracle_sql


def all_repairs(kinds):
    """Every sequence of edits with up to two insertions at a place: (cost, audit), by trying them all."""
    found = []

    def walk(i, state, cost, audit, inserted):
        if i == len(kinds) and state in (dr.START, dr.ASSISTANT):
            found.append((cost, audit))
        if inserted < 2:
            for letter, after in dr.FOLLOWS[state].items():
                if letter != "s":
                    walk(i, after, cost + 2, audit + "I", inserted + 1)
        if i < len(kinds):
            initial, fault = "sua "[kinds[i] % 4], kinds[i] - kinds[i] % 4
            walk(i + 1, state, cost + 3, audit + "D", 0)
            if fault != dr.GONE:
                stays = cost + (fault == dr.CUT)
                for letter, after in dr.FOLLOWS[state].items():
                    if letter == initial:
                        walk(i + 1, after, stays, audit + "K", 0)
                    if letter != "s":
                        walk(i + 1, after, stays + 2, audit + "R", 0)

    walk(0, dr.START, 0, "", 0)
    return min(found)


def pieces(kinds, cuts):
    parts = [bytes(kinds[a:b]) for a, b in pairwise([0, *cuts, len(kinds)])]
    cost, ends = dr.crossings([dr.summary(part) for part in parts])
    done = [dr.edits(part, a, b, i == len(parts) - 1) for i, (part, a, b) in enumerate(zip(parts, [0, *ends], ends, strict=False))]
    return cost, "".join(edit for some in done for _, edit, _ in some)


def test_equals_all_repairs():
    rng = random.Random(11)
    for n in range(1, 6):
        for _ in range(40):
            kinds = [rng.randrange(12) for _ in range(n)]
            assert pieces(kinds, []) == all_repairs(kinds), kinds


def test_cuts_change_nothing():
    rng = random.Random(12)
    for _ in range(300):
        kinds = [rng.choice([0, 1, 2, 1, 2, 1, 2, 5, 6, 9, 3]) for _ in range(rng.randrange(2, 40))]
        cuts = sorted(rng.sample(range(1, len(kinds)), min(len(kinds) - 1, rng.randrange(6))))
        assert pieces(kinds, cuts) == pieces(kinds, []), (kinds, cuts)


def test_no_more_than_vectors_are_held():
    kinds = bytes([1, 2] * 20_000)
    cost, ends = dr.crossings([dr.STEPS[kind] for kind in kinds])
    assert cost == 0 and ends == [dr.USER, dr.ASSISTANT] * 20_000


@pytest.fixture()
def odd(spark, tmp_path):
    """Conversations of every odd kind, as a folder: null everything, ties, repeated rows, a long one, one that is all dropped."""
    rng = random.Random(4)
    rows = [(1, None, None, None), (1, 1, "user", "a."), (1, 1, "user", "a."), (1, 1, "assistant", "a."), (1, 5, "tool", "x!"), (None, 0, "user", "b?"), (None, None, "assistant", " \t")]
    rows += [(2, t, rng.choice(["system", "user", "assistant", "", "User"]), rng.choice(["yes.", "no", "", "\n", "so it is!  "])) for t in range(60)]
    rows += [(c, t, ["user", "assistant"][t % 2], f"line {t}.") for c in range(3, 40) for t in range(c % 7 + 1)]
    rows += [(99, t, ["user", "assistant"][t % 2], f"long {t}.") for t in range(9000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame.withColumn("audit", frame["role"]).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_odd_tables_equal_sql(spark, odd):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{odd}/conversations.parquet/*.parquet' WHERE conv_id IS NULL OR conv_id <> 99")
    frame = llm_queries.op12_repair(spark, odd)
    assert difference(frame.where("conv_id is null or conv_id <> 99"), con, oracle_sql()["op12_repair"]) is None


def test_long_conversation_in_pieces(spark, odd):
    given = spark.read.parquet(f"{odd}/conversations.parquet").where("conv_id = 99")
    turns = dr.ordered(llm_queries.damaged(given))
    parts = dr.segments(dr.with_faults(turns))
    assert parts.count() >= 3 and max(len(r["kinds"]) for r in parts.collect()) <= 4096
    known, rows = dr.repair(turns)
    kinds = [k for _, k in sorted((p, k) for r in parts.collect() for p, k in zip(r["places"], r["kinds"], strict=True))]
    (row,) = known.collect()
    assert (row["cost"], row["audit"]) == pieces(kinds, [])
    lines = [r["role"][0] for r in sorted(rows.collect(), key=lambda r: (r["pos"], r["step"])) if r["edit"] != "D"]
    assert "".join(lines).replace("ua", "") in ("", "s")


def test_hash_of_joined_lines(spark):
    rows = [(c, p, 0, f"{c}:{p}") for c in (1, 2, 3) for p in range(c * 900)]
    frame = spark.createDataFrame(rows, "conv bigint, pos bigint, step int, line string")
    found = {r["conv"]: r["sha256"] for r in llm_queries.joined_sha256(frame).collect()}
    assert found == {c: hashlib.sha256("\n".join(f"{c}:{p}" for p in range(c * 900)).encode()).hexdigest() for c in (1, 2, 3)}


def test_empty(spark, odd):
    given = spark.read.parquet(f"{odd}/conversations.parquet").limit(0)
    known, rows = dr.repair(dr.ordered(given))
    assert known.count() == 0 and rows.count() == 0
