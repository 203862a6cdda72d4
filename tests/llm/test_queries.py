from __future__ import annotations

import pytest
from compare import connect, difference

import corpus_pipeline
from changeloom.llm import language
from changeloom.llm.oracles import oracle_sql
from changeloom.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", oracle_sql())
def test_against_sql(spark, name):
    assert difference(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [name for name in queries() if name not in oracle_sql()])
def test_query_runs(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == docs.columns
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in kept.collect()} and len(corpus_pipeline.STAGES) == 5
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))


def test_pipeline_keeps_and_rejects(spark, docs):
    frame = docs.drop("shard").selectExpr("*", "cast(length(text) as bigint) as n_chars")
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, frame, FOLDER).collect()}
    assert not kept & {4, 5, 6} and language.UNKNOWN == "und"
