"""Aggregate analytics: lexicon, modes, ambiguity, collocation, weights, samples, components."""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

#: Terms that one document in so many holds are known to all tasks.
COMMON = 64


def lexicon(tokens: DataFrame, keys: list[str], anchor: str) -> DataFrame:
    return tokens.groupBy(*keys).agg(F.count("*").alias("noccs"), F.min(anchor).alias("first_anchor"))


def modal(rows: DataFrame, key: str, value: str, least: int = 1, sure: float = 0.0) -> DataFrame:
    """key, its modal value, confidence, both counts; ties go to the smaller value, floors drop weak keys."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("o"), F.col(value).alias("v"))).alias("b"), F.sum("n").alias("total_obs"))
    out = best.select(key, F.col("b.v").alias("value"), (-F.col("b.o")).alias("top_obs"), "total_obs").withColumn("confidence", F.round(F.col("top_obs") / F.col("total_obs"), 6))
    return out.where((F.col("total_obs") >= least) & (F.col("top_obs") >= sure * F.col("total_obs")))


def entropy(rows: DataFrame, key: str, value: str) -> DataFrame:
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    total = counts.groupBy(key).agg(F.sum("n").alias("total"), F.count("*").alias("candidates"), F.sum(F.col("n") * F.log2("n")).alias("nlogn"))
    return total.select(key, "candidates", "total", F.round(F.greatest(F.lit(0.0), F.log2("total") - F.col("nlogn") / F.col("total")), 6).alias("entropy"))


def top_k(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def collocations(line_words: DataFrame, window: int, least: int) -> DataFrame:
    """Ordered pairs within ``window`` words of a line, counted, with pointwise mutual information.

    ``line_words`` has an array ``ws`` a line.  Pairs are counted by their words' hashes, under a seed with which no two
    words of the table clash, so the counts are exact and no text is shuffled but that of each word once."""
    freq = written(line_words.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("f")), "words")
    words = freq.count()
    seed = next(s for s in count() if freq.select(F.xxhash64(F.lit(s), "w").alias("h")).distinct().count() == words)

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy()
            line = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
            for d in range(1, min(window, len(flat))):
                same = line[:-d] == line[d:]
                yield pa.RecordBatch.from_arrays([pa.array(flat[:-d][same]), pa.array(flat[d:][same])], ["a", "b"])

    hashed = line_words.select(F.transform("ws", lambda w: F.xxhash64(F.lit(seed), w)).alias("ws"))
    pairs = hashed.mapInArrow(run, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    total = freq.agg(F.sum("f").alias("total"))
    named = freq.select(F.xxhash64(F.lit(seed), "w").alias("h"), "w", "f")
    fa, fb = (named.select(F.col("h").alias(k), F.col("w").alias(f"w{k}"), F.col("f").alias(f"f{k}")) for k in "ab")
    joined = pairs.join(fa, "a").join(fb, "b").join(F.broadcast(total))  # one row
    return joined.select(F.col("wa").alias("a"), F.col("wb").alias("b"), "n", F.round(F.log2(F.col("n") * F.col("total") / (F.col("fa") * F.col("fb"))), 6).alias("pmi"))


def tfidf(counts: DataFrame, doc: str, term: str, n_docs: DataFrame, k: int | None = None) -> DataFrame:
    """counts has doc, term, tf; n_docs one row ``n``.  With ``k`` only terms that may be among the ``k`` heaviest of
    their document, all of those included.

    Terms that one document in ``COMMON`` holds are few, at most ``COMMON`` times the terms of a mean document, so all tasks
    know them; the weight of any other lies between tf * ln(COMMON) and tf * ln(n).  A term that can't reach the ``k``-th
    largest lower bound of its document is left out before the join."""
    df = counts.groupBy(term).agg(F.count("*").alias("df"))
    if k is not None:
        common = df.join(F.broadcast(n_docs)).where(F.col("df") * COMMON >= F.col("n")).select(F.col(term).alias("_t"), F.log(F.col("n") / F.col("df")).alias("_idf"))
        held = counts.join(F.broadcast(common), F.col(term).eqNullSafe(F.col("_t")), "left").join(F.broadcast(n_docs))
        low = held.select(doc, term, "tf", (F.col("tf") * F.coalesce("_idf", F.log(F.lit(float(COMMON))))).alias("_low"), (F.col("tf") * F.coalesce("_idf", F.log("n"))).alias("_high"))
        w = Window.partitionBy(doc).orderBy(F.desc("_low")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        least = F.coalesce(F.nth_value("_low", k).over(w), F.lit(float("-inf")))
        counts = low.withColumn("_least", least).where(F.col("_high") >= F.col("_least") - 1e-5).select(doc, term, "tf")  # weights are rounded
    return counts.join(df, term).join(F.broadcast(n_docs)).select(doc, term, "tf", F.round(F.col("tf") * F.log(F.col("n") / F.col("df")), 6).alias("weight"))


def stratified(rows: DataFrame, stratum: str, key: str, k: int, seed: str) -> DataFrame:
    """Exactly k of each stratum (or all), by a hash order that any engine can repeat."""
    return top_k(rows, [stratum], [F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))).asc()], k)


def min_label_components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each id of the edges (a, b) reaches.

    Each round hangs every neighbour larger than an id on the smallest of its neighbours, then every id's neighbours on
    the smallest of them, until the edges no longer change; rounds grow with the logarithm of the longest path."""
    ids = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).where("id IS NOT NULL").distinct()
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        root = down.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = down.join(root, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(root.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        new = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if new == mark:
            break
        mark = new
    return ids.join(now, F.col("id") == F.col("u"), "left").select("id", F.coalesce("v", "id").alias("label"))


def quantile(rows: DataFrame, by: str, value: str, q: float) -> DataFrame:
    """by, quantile: exact, interpolated between neighbours.  Values are counted, then ranked over ranges of (by, value),
    so no task holds a group."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("g"), F.col(value).alias("v")).agg(F.count("*").alias("n"))
    ranged = written(counts.repartitionByRange("g", "v").withColumn("p", F.spark_partition_id()), "ranks")
    sizes = ranged.groupBy("p", "g").agg(F.sum("n").alias("m"))
    w = Window.partitionBy("g").orderBy("p")
    before = sizes.select(F.col("p").alias("p2"), F.col("g").alias("g2"), (F.sum("m").over(w) - F.col("m")).alias("b"), F.sum("m").over(Window.partitionBy("g")).alias("total"))
    local = ranged.withColumn("c", F.sum("n").over(Window.partitionBy("p", "g").orderBy("v")))
    ranked = local.join(before, (F.col("p") == F.col("p2")) & F.col("g").eqNullSafe(F.col("g2")))  # a row for each part of a group
    at = (F.col("total") - 1) * q
    first, last = F.col("b") + F.col("c") - F.col("n"), F.col("b") + F.col("c") - 1
    held = lambda place: F.max(F.when((first <= place) & (place <= last), F.col("v")))
    ends = ranked.groupBy("g").agg(held(F.floor(at)).alias("lo"), held(F.ceil(at)).alias("hi"), F.max(at - F.floor(at)).alias("part"))
    return ends.select(F.col("g").alias(by), (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("quantile"))


def log_likelihood(n: Column, f1: Column, f2: Column, total: Column) -> Column:
    """G squared of a pair that occurs n times, by its words' counts and the number of places."""

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    cells = [(n, f1, f2), (f1 - n, f1, total - f2), (f2 - n, total - f1, f2), (total - f1 - f2 + n, total - f1, total - f2)]
    return 2 * sum((part(s, r * c / total) for s, r, c in cells), F.lit(0.0))
