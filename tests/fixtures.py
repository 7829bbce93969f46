"""Small tables the tests share."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession


def canvas(spark: SparkSession, n: int = 1000) -> DataFrame:
    rows = [(f"uuid-{i}", f"color-{i}", 31000 + i) for i in range(n)]
    return spark.createDataFrame(rows, "id string, color string, ordering int")


def three(spark: SparkSession) -> DataFrame:
    rows = [("123", "green", 1), ("another-uuid", "red", 2), ("greencanvas", "green", 3)]
    return spark.createDataFrame(rows, "id string, color string, ordering int")


def metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("another-uuid", "Some extra data")], "id string, extra_data string")


NULL_ROWS = [
    (1, 1, "red", True),
    (2, 2, "Red_1", False),
    (3, None, "blue%", None),
    (4, 5, None, True),
    (5, 2, "a\\b", None),
    (6, None, None, False),
    (7, 7, "", None),
]


def nulls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NULL_ROWS, "id int, a int, b string, f boolean")


def precedence(spark: SparkSession) -> DataFrame:
    rows = [(i, *bits) for i, bits in enumerate(product([False, True], repeat=3))]
    return spark.createDataFrame(rows, "id int, x boolean, y boolean, z boolean")


def family(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    parents = spark.createDataFrame([("p1", "Ann"), ("p2", "Bob")], "id string, name string").alias("p")
    children = spark.createDataFrame(
        [("c2", "p1", "second", 2, None), ("c1", "p1", "first", 1, "x"), ("c9", None, "orphan", 9, None)],
        "id string, parent_id string, label string, sort_ord int, note string",
    ).alias("c")
    grandchildren = spark.createDataFrame(
        [("g2", "c1", "beta"), ("g1", "c1", "alpha")], "id string, child_id string, tag string"
    ).alias("g")
    return parents, children, grandchildren


def ids(df: DataFrame, column: str = "id") -> list:
    return sorted(r[0] for r in df.select(column).collect())
