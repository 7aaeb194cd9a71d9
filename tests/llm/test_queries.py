"""Every registered query of the text operators, over the smallest tables."""

import random

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle_check import compare, duck
from tideline.llm.registered import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted([*QUERIES, "pipeline"]))
def test_query(spark, name):
    if name in oracle_sql():
        assert compare(spark, duck(SF), name, queries()[name], oracle_sql()[name], SF) is None
    else:
        assert queries()[name](spark, SF).count() > 0


def test_the_pipelines_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS score", "'x' AS `odd name.`")
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(set(ids)) == len(ids) <= left and ids
        assert {r.score for r in out.select("score").collect()} == {1}
        docs, left = out, len(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(ids)


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables_and_odd_rows(spark, k):
    import corpus_pipeline
    from tests.llm.data import documents, empty

    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, empty(spark), SF).collect() == []
    odd = stage(spark, documents(spark), SF)
    assert odd.count() > 0
    if k < 4:
        assert odd.columns == documents(spark).columns


def test_a_repeated_id_goes_only_with_the_text_that_is_a_copy(spark):
    from tests.llm.data import SCHEMA, words
    from tideline.llm import stages

    rng = random.Random(9)
    copied, clean, other = (words(rng, 80) for _ in range(3))
    rows = [(1, copied), (5, copied), (5, clean), (5, clean), (7, clean), (8, other), (8, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], SCHEMA)
    got = [(r.doc_id, r.text) for r in stages.keep_one_of_each(spark, docs, SF).collect()]
    assert sorted(got, key=repr) == sorted([(1, copied), (5, clean), (8, other), (8, ""), (8, None)], key=repr)
