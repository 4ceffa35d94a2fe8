"""Order within groups of any size: the next row, running sums.  A window over a group is one task's work; here the rows
are dealt out by ranges of their order, and only a row for each range and part of a group is carried between ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written


def dealt(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The rows with ``_p``, the number of their range in the order of ``by`` and ``order``; equal rows share a range."""
    return written(rows.repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()), "ranges")


def _same(by: list[str]):
    out = F.col("_p") == F.col("_q")
    for i, c in enumerate(by):
        out = out & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return out


def _edges(parts: DataFrame, by: list[str], **made) -> DataFrame:
    """A row for each range and part of a group, under names that clash with no column."""
    groups = [f"_g{i}" for i in range(len(by))]
    rows = parts.groupBy(F.col("_p").alias("_q"), *[F.col(c).alias(g) for c, g in zip(by, groups)])
    return rows.agg(*[v.alias(k) for k, v in made.items()])


def following(rows: DataFrame, by: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Adds ``next``, a struct of the next row's ``columns`` in its group, null for the last row."""
    parts = dealt(rows, by, order).withColumn("_x", F.struct(*columns))
    edges = _edges(parts, by, _first=F.min_by("_x", F.struct(*order)))
    later = Window.partitionBy(*[f"_g{i}" for i in range(len(by))]).orderBy("_q")
    edges = edges.withColumn("_after", F.lead("_first").over(later))
    inside = F.lead("_x").over(Window.partitionBy("_p", *by).orderBy(*order))
    both = parts.withColumn("_n", inside).join(edges, _same(by))
    return both.select(*rows.columns, F.coalesce("_n", "_after").alias("next"))


def running_sum(rows: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over the group's rows up to this one (rows of equal order by any order)."""
    parts = dealt(rows, by, order)
    edges = _edges(parts, by, _sum=F.sum(value))
    earlier = Window.partitionBy(*[f"_g{i}" for i in range(len(by))]).orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    local = F.sum(value).over(Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    both = parts.withColumn("_s", local).join(edges, _same(by))
    return both.select(*rows.columns, (F.col("_before") + F.col("_s")).alias(name))
