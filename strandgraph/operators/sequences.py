"""Ordered sequences against each other: first differences, edit operations, variants, matching blocks."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compare(a: DataFrame, b: DataFrame, by: str, pos: str, value: str, first: int = 5) -> DataFrame:
    """by, n_a, n_b, differing, first_at (the first ``first`` places that differ): place by place; nulls are values, also as keys."""
    left = a.select(F.col(by).alias("_b"), F.col(pos).alias("_p"), F.struct(F.col(value).alias("v")).alias("_x"))
    right = b.select(F.col(by).alias("_c"), F.col(pos).alias("_q"), F.struct(F.col(value).alias("v")).alias("_y"))
    both = left.join(right, F.col("_b").eqNullSafe(F.col("_c")) & F.col("_p").eqNullSafe(F.col("_q")), "full_outer")
    place, apart = F.coalesce("_p", "_q"), ~F.col("_x").eqNullSafe(F.col("_y"))
    found = both.select(F.coalesce("_b", "_c").alias(by), "_x", "_y", place.alias("_p"), apart.alias("_d"))
    rank = F.sum(F.col("_d").cast("int")).over(Window.partitionBy(by).orderBy("_p"))
    few = found.withColumn("_r", rank)
    return few.groupBy(by).agg(
        F.count("_x").alias("n_a"), F.count("_y").alias("n_b"), F.count_if("_d").alias("differing"), F.sort_array(F.collect_list(F.when(F.col("_d") & (F.col("_r") <= first), F.col("_p")))).alias("first_at")
    )


def opcodes(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """keys, ord, op, a_lo, a_hi, b_lo, b_hi of the edits (no equal runs) that turn the array a into b; map side."""

    def run(frames):
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                *key, x, y = r
                ops = [o for o in SequenceMatcher(None, list(x), list(y), autojunk=False).get_opcodes() if o[0] != "equal"]
                rows += [(*key, n, *o) for n, o in enumerate(ops)]
            yield pd.DataFrame(rows, columns=[*keys, "ord", "op", "a_lo", "a_hi", "b_lo", "b_hi"])

    kinds = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys)
    return pairs.select(*keys, F.coalesce(a, F.array()).alias("_a"), F.coalesce(b, F.array()).alias("_b")).mapInPandas(run, f"{kinds}, ord int, op string, a_lo int, a_hi int, b_lo int, b_hi int")


def variants(docs: DataFrame, group: str, key: str, words: str) -> DataFrame:
    """The edits from the first text of each group to each other one: group, key, other and ``opcodes``' columns.
    Each text meets one other, so a group costs as many pairs as it has texts."""
    first = docs.groupBy(F.col(group).alias("_g")).agg(F.min(F.struct(F.col(key).alias("k"), F.col(words).alias("w"))).alias("f"), F.count("*").alias("_n")).where("_n > 1")
    pairs = docs.join(first, F.col(group) == F.col("_g")).where(F.col(key) != F.col("f.k"))
    return opcodes(pairs.select(F.col(group).alias("group"), F.col("f.k").alias("key"), F.col(key).alias("other"), F.col("f.w").alias("_x"), F.col(words).alias("_y")), ["group", "key", "other"], "_x", "_y")


def blocks(pairs: DataFrame, keys: list[str], a: str, b: str, least: int = 5) -> DataFrame:
    """keys, a_at, b_at, size of the runs of at least ``least`` words that two arrays share, in order."""

    def run(frames):
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                *key, x, y = r
                rows += [(*key, m.a, m.b, m.size) for m in SequenceMatcher(None, list(x), list(y), autojunk=False).get_matching_blocks() if m.size >= least]
            yield pd.DataFrame(rows, columns=[*keys, "a_at", "b_at", "size"])

    kinds = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys)
    return pairs.select(*keys, F.coalesce(a, F.array()).alias("_a"), F.coalesce(b, F.array()).alias("_b")).mapInPandas(run, f"{kinds}, a_at int, b_at int, size int")
