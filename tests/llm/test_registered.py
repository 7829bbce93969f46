"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import hashlib

import duckdb
import pytest
from check_oracle import duck, rows_by_name
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection() -> duckdb.DuckDBPyConnection:
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_agrees_with_sql(spark, connection, name):
    ours = queries.QUERIES[name](spark, FOLDER)
    answer = connection.execute(queries.SQL[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(ours.columns)
    assert rows_by_name(ours.columns, ours.collect()) == rows_by_name(names, answer.fetchall())


def test_line_join_rewrites_texts(spark):
    """What op2 returns is of the new texts: the spans kept of each document, one after the other, have the digest given."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.op2_line_join(spark, FOLDER).collect()
    assert {r.doc_id for r in found} == set(texts) and sum(r.n_removed for r in found) > 0
    for r in found:
        spans = [tuple(map(int, x.split("-"))) for x in r.kept.split(",") if x]
        assert hashlib.sha256("".join(texts[r.doc_id][a:b] for a, b in spans).encode()).hexdigest() == r.text_sha256


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_covers_the_table(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).select("doc_id").distinct().count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, FOLDER)
        made.write.parquet(str(tmp_path / str(i)))
        made = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == columns
            assert made.count() <= docs.count() and made.where("n_chars <> length(text)").count() == 0
            before, docs = docs, made
    assert made.select(F.sum("n_tokens")).first()[0] == docs.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    # what a later stage has left is stable under it
    assert corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER).exceptAll(docs).count() == 0
    assert before.select("doc_id").subtract(docs.select("doc_id")).count() == 0


def test_pipeline_takes_short_lines(spark):
    """Lines of fewer than five words go too, as do long ones in a script without spaces, which are one word."""
    long = "\u8a9e\u6587" * 40
    docs = spark.createDataFrame([(1, f"Read more\n{long}\n\n"), (2, f"own\n\nread MORE!\n{long}")], "doc_id long, text string")
    for stage in (corpus_pipeline.drop_near_lines, corpus_pipeline.drop_repeated_lines):
        assert {r.doc_id: r.text for r in stage(spark, docs, FOLDER).collect()} == {1: f"Read more\n{long}\n\n", 2: "own\n\n"}


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
