"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, sized


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
    return both.join(sized(least, 2 * rows), F.col("u") == F.col("k")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    linked = down.join(sized(least, rows), F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, int]:
    """(id, component) of every id with an edge, and a bound of the number of ids; the component is its smallest
    id.  Each round writes its edges to the shared folder; rounds grow with the logarithm of the longest path.  The
    minima of few edges, by count, are broadcast; those of more are shuffled.  No edges give no rows."""
    now = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark, rows = None, now.count()
    while True:
        now = materialise(_small_star(_large_star(now, rows), rows).distinct(), "edges")
        new = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        rows = new[0]
        if new == mark:
            break
        mark = new
    ids = now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
    return materialise(ids, "components"), 2 * rows
