"""Stylometry: weighted character n-grams of texts, a truncated factorisation, and clusters, with ``pyspark.ml``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import let
from ..sources.shared import written
from ..sources.tables import bounded

#: Buckets of n-grams; the factorisation holds a matrix of their square on the driver, whatever the texts.
BUCKETS = 2048
#: Bytes of text that are hashed together, and texts whose weights stand in one matrix.
PIECE, ROWS = 1 << 16, 512


def char_ngrams(text: Column, least: int = 3, most: int = 5) -> Column:
    """All runs of ``least`` to ``most`` characters, white space as one blank."""

    def runs(chars, k):
        n = F.size(chars)
        each = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.concat(*[F.get(chars, i - 1 + j) for j in range(k)]))
        return F.when(n >= k, each).otherwise(F.array().cast("array<string>"))

    def grams(chars):
        return F.concat(*[runs(chars, k) for k in range(least, most + 1)])

    return let(F.regexp_extract_all(F.regexp_replace(F.coalesce(text, F.lit("")), "\\s+", " "), F.lit("(?s)."), F.lit(0)), grams)


def _one_blank(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts and where each ends, with runs of white space as one blank; the borders of texts part them."""
    white = (data == 32) | (data - np.uint8(9) < 5)
    again = np.zeros(len(data), bool)
    again[1:] = white[1:] & white[:-1]
    again[ends[:-1][ends[:-1] < len(data)]] = False
    keep = ~again
    return np.where(white, np.uint8(32), data)[keep], np.append(0, np.cumsum(keep))[ends]


def _hashed(data: np.ndarray, ends: np.ndarray, least: int, most: int, buckets: int):
    """Arrays of the buckets of runs of characters, as ``HashingTF`` gives them: Murmur3 of the run's bytes.  Runs of one
    length in bytes are hashed together, at all places at once where many are; a text's buckets follow the last one's."""
    n = len(data)
    wide = np.append(data, np.zeros(4, np.uint8)).astype(np.uint32)
    four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    edges = np.append(np.flatnonzero(data & 0xC0 != 0x80), n)  # where characters begin, and the end
    lengths = np.diff(ends, prepend=0)
    shift, last = np.repeat(np.arange(len(ends)) * buckets, lengths), np.repeat(ends, lengths)
    starts, sizes = [], []
    for k in range(least, most + 1):
        first, to = edges[: max(len(edges) - k, 0)], edges[k:]
        inside = to <= last[first]
        starts.append(first[inside])
        sizes.append(to[inside] - starts[-1])
    starts, sizes = np.concatenate(starts), np.concatenate(sizes)

    def mixed(k):
        k = k * np.uint32(0xCC9E2D51)
        return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)

    def turned(h):
        return (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)

    block = mixed(four)
    begun = turned(block ^ np.uint32(42))
    for size in np.flatnonzero(np.bincount(sizes)).tolist():
        at = starts[sizes == size]
        whole = 3 * len(at) > n
        seen = (lambda x, i: x[i : n - size + 1 + i]) if whole else (lambda x, i: x[at + i])
        h = seen(begun, 0) if size >= 4 else np.uint32(42)
        for i in range(4, size - 3, 4):
            h = turned(h ^ seen(block, i))
        if size % 4:
            h = h ^ mixed(seen(four, size - size % 4) & np.uint32(256 ** (size % 4) - 1))
        h = h ^ np.uint32(size)
        for r, c in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ h >> np.uint32(r)) * np.uint32(c)
        h = h ^ h >> np.uint32(16)
        h = h & np.uint32(buckets - 1) if buckets & (buckets - 1) == 0 else h.view(np.int32) % np.int32(buckets)
        yield shift[at] + (h[at] if whole else h)


def counted(docs: DataFrame, key: str, text: str, least: int = 3, most: int = 5, buckets: int = BUCKETS) -> DataFrame:
    """key, at, n: how often each text has runs of ``least`` to ``most`` characters in each bucket, as ``char_ngrams``
    gives them; map side, some short texts at a time."""

    def run(batches):
        for b in batches:
            texts = b.column(1).fill_null("").cast(pa.large_binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            i = 0
            while i < len(texts):
                before = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + PIECE, "right")))
                data = np.frombuffer(b"".join(texts[i:j].to_pylist()), np.uint8)
                sums = np.zeros((j - i) * buckets, np.int64)
                for found in _hashed(*_one_blank(data, ends[i:j] - before), least, most, buckets):
                    sums += np.bincount(found, minlength=len(sums))
                at = np.flatnonzero(sums)
                cuts = pa.array(np.searchsorted(at, np.arange(j - i + 1) * buckets).astype(np.int32))
                flat = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (at % buckets, sums[at])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *flat], [key, "at", "n"])
                i = j

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, at array<int>, n array<int>")


def _idf(counts: DataFrame, buckets: int) -> np.ndarray:
    """The inverse document frequency of each bucket, as ``pyspark.ml`` defines it; tasks count, the driver gets a number a
    bucket."""

    def run(batches):
        total = np.zeros(buckets + 1, np.int64)
        for b in batches:
            total[:-1] += np.bincount(b.column(0).flatten().to_numpy(), minlength=buckets)
            total[-1] += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets + 1)), pa.array(total)], ["i", "n"])

    df = np.zeros(buckets + 1)
    for r in counts.select("at").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        df[r.i] = r.n
    return np.log((df[-1] + 1) / (df[:-1] + 1))


def vectors(docs: DataFrame, key: str, text: str, least: int = 3, most: int = 5, buckets: int = BUCKETS) -> DataFrame:
    """key, the places and weights of each text, and both as a vector ``weights``: counts by inverse document frequency, of
    length 1; an empty text has none.  The counts are written, as the steps that follow read them several times."""
    bounded(docs.sparkSession)
    counts = written(counted(docs, key, text, least, most, buckets), "ngrams")
    idf = F.array(*[F.lit(float(x)) for x in _idf(counts, buckets)])
    raw = F.zip_with("at", "n", lambda a, n: n * F.get(idf, a))
    norm = lambda w: F.sqrt(F.aggregate(w, F.lit(0.0), lambda s, x: s + x * x))
    scaled = let(raw, lambda w: let(norm(w), lambda n: F.when(n > 0, F.transform(w, lambda x: x / n)).otherwise(w)))
    sparse = F.udf(lambda at, w: Vectors.sparse(buckets, at, w), VectorUDT())
    return counts.select(key, "at", scaled.alias("w")).withColumn("weights", sparse("at", "w"))


def _dense(at: pa.ListArray, w: pa.ListArray, buckets: int):
    """The weights of up to ``ROWS`` texts at a time as a matrix."""
    for i in range(0, len(at), ROWS):
        a, n = at.slice(i, ROWS), len(at[i : i + ROWS])
        x = np.zeros((n, buckets))
        x[np.repeat(np.arange(n), a.value_lengths().to_numpy()), a.flatten().to_numpy()] = w.slice(i, ROWS).flatten().to_numpy()
        yield x


def _covariance(weighted: DataFrame, buckets: int) -> np.ndarray:
    """The covariance of the weights: a task sums products and hands on a row of them for each bucket; the rows are summed
    by bucket, and the driver gets one matrix.  Tasks are a few for each core, however long the table is."""

    def products(batches):
        sums, total, n = np.zeros((buckets, buckets)), np.zeros(buckets), 0
        for b in batches:
            for x in _dense(b.column(0), b.column(1), buckets):
                sums += x.T @ x
                total += x.sum(0)
                n += len(x)
        if n:
            task = TaskContext.get().partitionId()
            for i in range(0, buckets, ROWS):
                rows = range(i, min(i + ROWS, buckets))
                yield pa.RecordBatch.from_pydict({"i": pa.array(rows, pa.int32()), "task": pa.array([task] * len(rows), pa.int32()), "sums": pa.array([sums[r, r:].tobytes() for r in rows], pa.binary())})
            yield pa.RecordBatch.from_pydict({"i": pa.array([-1], pa.int32()), "task": pa.array([task], pa.int32()), "sums": pa.array([np.append(total, n).tobytes()], pa.binary())})

    def summed(table):
        table = table.sort_by("task")  # one order of the sums, whatever comes first
        whole = sum(np.frombuffer(x.as_py()) for x in table["sums"])
        return pa.table({"i": table["i"][:1], "sums": pa.array([whole.tobytes()], pa.binary())})

    parts = weighted.select("at", "w").coalesce(2 * weighted.sparkSession.sparkContext.defaultParallelism)
    found = {r.i: np.frombuffer(r.sums) for r in parts.mapInArrow(products, "i int, task int, sums binary").groupBy("i").applyInArrow(summed, "i int, sums binary").collect()}
    out = np.zeros((buckets, buckets))
    if found:
        n, mean = found[-1][-1], found[-1][:-1] / found[-1][-1]
        for i in range(buckets):
            out[i, i:] = out[i:, i] = (found[i] - n * mean[i] * mean[i:]) / max(n - 1, 1)
    return out


def reduced(weighted: DataFrame, key: str, k: int = 16, buckets: int = BUCKETS) -> DataFrame:
    """key and ``place``, the ``k`` principal components of the weights; distances stay as near as rank ``k`` allows.  The
    tasks sum the covariance; the driver takes the matrix of ``buckets`` squared apart."""
    bounded(weighted.sparkSession)
    covariance = _covariance(weighted, buckets)
    held = np.flatnonzero(np.diag(covariance) > 0)
    axes = np.zeros((buckets, k))
    found = np.linalg.eigh(covariance[np.ix_(held, held)])[1][:, ::-1][:, :k]
    axes[held, : found.shape[1]] = found

    def run(batches):
        for b in batches:
            places = np.concatenate([np.zeros((0, k)), *(x @ axes for x in _dense(b.column(1), b.column(2), buckets))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * k, pa.int32()), pa.array(places.ravel()))], [key, "place"])

    kind = weighted.schema[key].dataType.simpleString()
    return written(weighted.select(key, "at", "w").mapInArrow(run, f"{key} {kind}, place array<double>").select(key, array_to_vector("place").alias("place")), "places")


def clusters(places: DataFrame, key: str, k: int, seed: int = 1) -> DataFrame:
    """key, cluster (by k-means from a fixed seed) and the distance to its centre.  The first centres are drawn partition by
    partition, so rows are dealt and ordered by their keys, not as files happen to be listed."""
    dealt = places.repartition(8 + places.count() // 100_000, key).sortWithinPartitions(key)
    model = KMeans(k=k, seed=seed, featuresCol="place", predictionCol="cluster").fit(dealt)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    away = F.zip_with(vector_to_array("place"), F.get(centres, F.col("cluster")), lambda a, b: (a - b) * (a - b))
    return model.transform(places).select(key, "cluster", F.sqrt(F.aggregate(away, F.lit(0.0), lambda s, x: s + x)).alias("distance"))
