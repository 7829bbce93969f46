"""A corpus from raw documents: toxic ones go, near-repeated lines go, one of each group of near copies stays, repeated lines
go, and what is left is packed. Each stage reads what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm import jaccard_join, line_join, packing, toxicity, unit_dedup
from tablewright.llm.queries import CATEGORIES
from tablewright.llm.shared import stored, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier chain calls toxic go. It learns from the labels of what it is given."""
    chain = toxicity.fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), CATEGORIES)
    return toxicity.reject_toxic(docs, chain)


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' own columns, n_chars brought up to date with the text where there is such a column."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def drop_near_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines with a word that nearly repeat an earlier line go, however short; the documents stay."""
    return _with_length(line_join.remove_near_repeats(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of the documents that links connect the one with the smallest id stays; rows without id stay."""
    found = jaccard_join.jaccard_components(docs)
    later, key = found.where("component_id < doc_id").select("doc_id").distinct(), unused("later_id", docs)
    return docs.join(later.withColumnRenamed("doc_id", key), F.col("doc_id") == F.col(key), "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: lines that repeat an earlier one go, however short; so do sentences, which the stages before leave where
    line breaks fall differently. The documents stay."""
    return _with_length(unit_dedup.remove_repeated_units(docs, unit="sentence"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: where each piece of each document lies."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_near_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_repeated_lines),
    ("best-fit packing", pack),
]

#: The first stage trains a model and the last packs greedily, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
