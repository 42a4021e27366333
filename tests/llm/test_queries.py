"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbflow.llm import queries
from tests.comparing import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables absent")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) is None


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == columns, name
        rows = out.select("doc_id", "text", "n_chars").collect()
        assert {r.doc_id for r in rows} <= ids
        if name == "suffix_dedup":
            assert len(rows) == docs.count() and all(r.n_chars == len(r.text) for r in rows)
        docs = corpus_pipeline.stored(out, name)
        ids = {r.doc_id for r in rows}
    packed = corpus_pipeline.pack(spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []
