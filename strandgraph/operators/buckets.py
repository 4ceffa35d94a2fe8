"""Interval joins inside a key that may hold any number of ranges: by buckets of the axis.

A range that others are looked for in is copied to each bucket of ``WIDTH`` slots that it covers; the other side goes to
one bucket, or a pair counts only in the bucket of its first shared slot, so each pair comes once and nothing is made
distinct.  A task sees a bucket, not a key.  Nested ranges, as those of a text, make at most depth times slots divided
by ``WIDTH`` copies besides their own rows.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 4096


def spread(rows: DataFrame, lo: str, hi: str, width: int, name: str = "_b") -> DataFrame:
    """A row for each bucket that lo to hi covers; empty ranges have none."""
    first, last = F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)
    return rows.where(F.col(lo) <= F.col(hi)).withColumn(name, F.explode(F.sequence(first, last)))


def _renamed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumnRenamed(key, "_k")


def within(outer: DataFrame, inner: DataFrame, key: str, at: tuple[str, str] = ("lo", "hi"), inner_at: tuple[str, str] = ("p_lo", "p_hi"), width: int = WIDTH) -> DataFrame:
    """Pairs of an outer range with an inner one of its key that lies in it; their other columns must differ in name."""
    (lo, hi), (p_lo, p_hi) = at, inner_at
    there = _renamed(inner, key).withColumn("_c", F.floor(F.col(p_lo) / width))
    held = (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_c")) & (F.col(p_lo) >= F.col(lo)) & (F.col(p_hi) <= F.col(hi))
    return spread(outer, lo, hi, width).join(there, held).drop("_b", "_c", "_k")


def meeting(a: DataFrame, b: DataFrame, key: str, at: tuple[str, str] = ("lo", "hi"), other_at: tuple[str, str] = ("p_lo", "p_hi"), width: int = WIDTH) -> DataFrame:
    """Pairs of ranges of a key that share a slot."""
    (lo, hi), (p_lo, p_hi) = at, other_at
    there = spread(_renamed(b, key), p_lo, p_hi, width, "_c")
    first = F.floor(F.greatest(lo, p_lo) / width)
    held = (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_c")) & (F.col(lo) <= F.col(p_hi)) & (F.col(p_lo) <= F.col(hi)) & (first == F.col("_b"))
    return spread(a, lo, hi, width).join(there, held).drop("_b", "_c", "_k")


def lacking(outer: DataFrame, inner: DataFrame, key: str, at: tuple[str, str] = ("lo", "hi"), inner_at: tuple[str, str] = ("p_lo", "p_hi"), overlaps: bool = False, width: int = WIDTH) -> DataFrame:
    """The outer ranges that hold no inner one whole, or, with ``overlaps``, share a slot with none."""
    held = (meeting if overlaps else within)(outer.select(key, *at).distinct(), inner.select(key, *inner_at), key, at, inner_at, width)
    found = held.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate((key, *at))]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate((key, *at))]
    return outer.join(found, same[0] & same[1] & same[2], "left_anti")


def innermost(ranges: DataFrame, inner: DataFrame, key: str, node: str, width: int = WIDTH) -> DataFrame:
    """key, ``node`` and holder of every inner range (node, p_lo, p_hi): the narrowest range (node, lo, hi) of its key that
    holds it, of as narrow ones the latest, then the smallest node; null where none does.  Ranges may nest and overlap.

    A sweep over each bucket keeps the ranges that are open, by width; a range that began in an earlier bucket is
    opened at the bucket's start."""
    kind, nodes = ranges.schema[key].dataType.simpleString(), ranges.schema[node].dataType.simpleString()
    start: Column = F.greatest(F.col("lo"), F.col("_b") * width)
    opened = spread(ranges, "lo", "hi", width).select(F.col(key).alias("k"), F.col("_b").alias("b"), start.cast("long").alias("at"), F.lit(False).alias("asks"), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), F.col(node).alias("node"))
    asked = inner.select(F.col(key).alias("k"), F.floor(F.col("p_lo") / width).alias("b"), F.col("p_lo").cast("long").alias("at"), F.lit(True).alias("asks"), F.col("p_lo").cast("long").alias("lo"), F.col("p_hi").cast("long").alias("hi"), F.col(node).alias("node"))

    def sweep(batches):
        group, open_ = None, []
        for batch in batches:
            keys, bs, ats, asks, los, his, ids = (c.to_pylist() for c in batch.columns)
            rows, holders = [], []
            for i in range(len(keys)):
                if (keys[i], bs[i]) != group:
                    group, open_ = (keys[i], bs[i]), []
                if not asks[i]:
                    bisect.insort(open_, (his[i] - los[i], -los[i], ids[i], his[i]))
                    continue
                if open_ and any(o[3] < ats[i] for o in open_):
                    open_ = [o for o in open_ if o[3] >= ats[i]]  # ended before this place
                rows.append(i)
                holders.append(next((o[2] for o in open_ if o[3] >= his[i]), None) if his[i] is not None and los[i] is not None and keys[i] is not None else None)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(6).take(at), pa.array(holders, batch.column(6).type)], ["k", "node", "holder"])

    dealt = opened.where("k IS NOT NULL").unionByName(asked).repartition("k", "b").sortWithinPartitions("k", "b", "at", "asks")
    return dealt.mapInArrow(sweep, f"k {kind}, node {nodes}, holder {nodes}").select(F.col("k").alias(key), F.col("node").alias(node), "holder")
