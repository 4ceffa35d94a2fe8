"""A store of graph nodes, partitioned by type and bucketed by document, so that one type is read without the others and
types of one document meet without a shuffle.

A document's nodes of a type lie in one bucket: the store suits joins on the document with few matches each; documents so
long that a task can't hold one are joined by ``operators.buckets`` instead.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import folder


def save(nodes: DataFrame, otype: str = "otype", doc: str = "doc", order: tuple[str, ...] = ("lo",), buckets: int = 16) -> str:
    """Writes the nodes and returns the table's name; a null type is the type ``none``."""
    path = folder(nodes.sparkSession, "graph")
    name = posixpath.basename(path).replace("-", "_")
    typed = nodes.withColumn(otype, F.coalesce(F.col(otype), F.lit("none")))
    dealt = typed.repartition(buckets, doc)  # a file for each type and bucket
    dealt.write.partitionBy(otype).bucketBy(buckets, doc).sortBy(doc, *order).option("path", path).format("parquet").saveAsTable(name)
    return name


def nodes_of(spark: SparkSession, name: str, kind: str, otype: str = "otype") -> DataFrame:
    """The nodes of one type; only its partition is read."""
    return spark.table(name).where(F.col(otype) == kind).drop(otype)
