"""Cutting lineage: written tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Stands in for the shared folder where a local session has none, as in tests.
_OWN: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, else below the context's checkpoint folder; only a local session gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        if "path" not in _OWN:
            _OWN["path"] = tempfile.mkdtemp(prefix="tallybridge-")
        base = _OWN["path"]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df as a table: computed once, its size known to the optimiser, and safe when executors go."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def file_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tables written meanwhile have files of so many rows at most.

    Spark counts 4 MB for opening a file and packs up to 128 MB for a task, so a task reads 32 such files at most, however small they are.
    """
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
