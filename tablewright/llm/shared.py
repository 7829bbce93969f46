"""Small helpers of the corpus operators: shared storage between steps, column names, words."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a longest run of characters other than ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Spark's own switch to delete a query's shuffle files when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see: the cluster's spark.checkpoint.dir; on one machine without it a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir names no folder that all machines of {master or 'the cluster'} share; set it")
        folder = "file://" + tempfile.mkdtemp(prefix="tablewright-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(frame: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """The frame, written to shared storage and read again: computed once, short lineage, safe from lost executors.

    rows says about how many rows it has, so that a small table becomes few files.
    """
    spark = frame.sparkSession
    if rows is not None:
        frame = frame.coalesce(1 + rows // 20_000)
    path = f"{shared_folder(spark)}/tablewright/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    made = spark.read.schema(frame.schema).parquet(path)
    made.stored_at = path  # type: ignore[attr-defined]
    return made


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that no frame in use reads any more."""
    for frame in frames:
        jvm, context = frame.sparkSession._jvm, frame.sparkSession._jsc
        path = jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, _UPPER, _LOWER)


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, however often body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
