"""Tables in the folder that driver and executors share; they cut lineage, so a lost executor costs no earlier step."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Paths handed out inside ``scratch``, by its nesting.
_made: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    """Deletes what lies at a path of any file system that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that were written inside; results that read them must be written by then, to a
    path made before."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            delete(spark, path)


def folder(spark: SparkSession, label: str) -> str:
    """A fresh path below spark.checkpoint.dir; where that is unset, a local one, on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file:///tmp/strandgraph-shared"
    path = posixpath.join(base, f"{label}-{uuid.uuid4().hex}")
    if _made:
        _made[-1].append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written and read back."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
