"""Queries with SQL against it; the pipeline against its stages."""

from __future__ import annotations

import pytest

import brute
import corpus_pipeline
from check import connect, difference
from conftest import SF_SMALL
from ebbtide.llm import decontamination, signature_tree
from ebbtide.llm.common import table
from ebbtide.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert difference(spark, connect(SF_SMALL), SF_SMALL, QUERIES[name], ORACLES[name]) is None


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = table(spark, SF_SMALL, "documents"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    documents = table(spark, SF_SMALL, "documents")
    for docs in stages[:-1]:
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes


def test_stages_do_their_work(spark, stages):
    toxic, near, passages, clean, _ = ({r["doc_id"]: r["text"] for r in s.select("doc_id", "text").collect()} if "text" in s.columns else None for s in stages)
    want = brute.near(toxic)
    assert near == {i: t for i, t in toxic.items() if want[i] == i}
    assert set(passages) <= set(near) and not brute.repeated_words(passages, 50)
    found = {r["doc_id"] for r in decontamination.find_leaks(stages[2], table(spark, SF_SMALL, "benchmark")).collect()}
    assert clean == {i: t for i, t in passages.items() if i not in found}
    assert {r["doc_id"] for r in stages[4].select("doc_id").distinct().collect()} == set(clean)


def test_run_is_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.columns == stages[-1].columns
    assert rows.select("doc_id", "doc_tokens").distinct().count() == stages[-1].select("doc_id", "doc_tokens").distinct().count()


def test_near_duplicates_of_the_small_table(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    got = {r["doc_id"]: r["component_id"] for r in signature_tree.near_documents(table(spark, SF_SMALL, "documents")).collect()}
    assert got == brute.near(texts)
