"""Reading tables from a folder, and storing what a batch of writes made of them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.writes import Tables, Write, apply_batch


def load(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The named Parquet tables of a folder, each aliased by its name."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet").alias(name) for name in names}


@dataclass(frozen=True)
class StoredBatch:
    """The new folder of each table that the batch names, and how many rows each of its writes touched."""

    folders: dict[str, str]
    counts: list[int]


def store_batch(tables: Tables, writes: Sequence[Write], root: str) -> StoredBatch:
    """Run the writes in order, all or nothing, and write each table they name to a new folder under ``root``.

    The counts are observed in the tasks that write, which count once even if they are run again: no table is read for them.
    Nothing that existed is changed: the caller goes on with the new folders, or with the old ones if this raises, in which
    case what was written so far is deleted. ``root`` must be storage that all machines see.
    """
    batch = apply_batch(tables, writes)
    spark = batch.counts.sparkSession
    folders: dict[str, str] = {}
    try:
        counts = [0] * len(writes)
        for name, table in batch.watched.items():
            folders[name] = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
            seen = Observation()
            replace(table, frame=table.frame.observe(seen, *table.counts)).rows.write.parquet(folders[name])
            for i in table.marks:
                counts[i] = seen.get[f"write_{i}"]
    except BaseException:
        for folder in folders.values():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        raise
    return StoredBatch(folders, counts)
