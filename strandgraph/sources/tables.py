"""The relational tables as Parquet, read with column pruning and pushed filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(rows: DataFrame, size: int) -> int:
    """How many parts of about ``size`` of the rows there are, three a core at least; the rows are counted."""
    return max(3 * rows.sparkSession.sparkContext.defaultParallelism, rows.count() // size)


def dealt(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """The rows dealt by keys into as many parts, so that a task's share doesn't grow with the table."""
    return rows.repartition(parts(rows, size), *keys)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over all cores, for work that is long for each row: a small file is one task otherwise."""
    return rows.repartition(3 * rows.sparkSession.sparkContext.defaultParallelism)


def bounded(spark: SparkSession, rows: int = 1024) -> None:
    """From now on Arrow hands Python at most so many rows at once, so a worker's memory holds few texts; a smaller setting
    of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = int(spark.conf.get(key, "10000"))
    if most <= 0 or most > rows:
        spark.conf.set(key, str(rows))
