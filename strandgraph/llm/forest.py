"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all of them, exact rerank.

The trees are fitted on at most about ``SAMPLE`` vectors, chosen by a hash; that is the only sample.  A node splits at
the median of its sample's projections on a random direction, of ``DIRECTIONS`` tried the one of largest spread.  Every
row is then routed down every tree, so all are indexed.  A query pops nodes of all trees from one queue, least
penalty first, where going to the far side of a split adds the squared distance to it; its first ``visits`` leaves
are searched.  ``visits`` is measured, not guessed: true neighbours of at most ``PROBES`` queries are found by a pass
over all rows, and the least number of visits under which the leaves hold the share ``recall`` of them is taken.
Vectors without structure so get many visits, at most all, which is brute force.

A leaf's rows and the queries that visit it meet in a task, in chunks of about ``CHUNK`` rows: a leaf of any size is
spread, and each chunk gives a query's ten nearest at most.  A task joins what its chunks give before it passes on.
Copies of one vector are searched once, with their ``k`` + 1 smallest ids, which no query needs more of.  Queries left
with fewer than ``k`` results visit all leaves of one tree, which is exact.

Edge cases: vectors that are null, zero, empty or hold a null, non-finite or over 1e150 large component take no part,
nor do rows with a null id or with another length than most vectors (of as many, the shorter).  Rows that repeat an
id are one row with several vectors, as near as the nearest pair.  Fewer candidates than ``k`` are all returned; a
query without any has no row.  An empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialise

#: Vectors that the trees are fitted on, queries that the visits are measured with.
SAMPLE, PROBES = 32_768, 64
#: Rows of a leaf at which trees end, and their greatest depth; beyond 2 to that depth leaves, leaves grow with the table.
LEAF, DEEPEST = 1024, 12
TREES, DIRECTIONS, CHUNK = 6, 6, 4096
_HELD = 200_000  # pairs that a task holds before it joins them


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, summed component by component, so equal vectors give equal bits anywhere."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += (a[:, j] - b[:, j]) ** 2
    return np.sqrt(total)


def nearest_pairs(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """(query, row, distance) of each query's ``k`` nearest rows with another id, and of all that rounding may tie."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    sizes = np.einsum("ij,ij->i", rows, rows)
    for i in range(0, len(queries), 256):
        q, ids = queries[i : i + 256], query_ids[i : i + 256]
        own = np.einsum("ij,ij->i", q, q)
        far = own[:, None] + sizes - 2 * (q @ rows.T)
        far[ids[:, None] == row_ids] = np.inf
        last = np.partition(far, k - 1, 1)[:, k - 1] if far.shape[1] > k else np.full(len(q), np.inf)
        near = (far <= (last + 1e-9 * (own + sizes.max(initial=0)))[:, None]) & (far < np.inf)
        a, b = np.nonzero(near)
        out.append((ids[a], row_ids[b], distances(q[a], rows[b])))
    return [np.concatenate(x) for x in zip(*out)]


def least(query: np.ndarray, row: np.ndarray, far: np.ndarray, k: int):
    """Each query's ``k`` nearest rows, each row once; equal distances by smaller row."""
    order = np.lexsort((far, row, query))
    query, row, far = query[order], row[order], far[order]
    once = np.append(True, (query[1:] != query[:-1]) | (row[1:] != row[:-1]))[: len(query)]
    query, row, far = query[once], row[once], far[once]
    order = np.lexsort((row, far, query))
    query, row, far = query[order], row[order], far[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], row[place < k], far[place < k]


class Forest:
    """Complete binary trees of ``depth`` levels; the children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 1):
        rng, inner = np.random.default_rng(seed), 2**depth - 1
        self.trees, self.depth = trees, depth
        self.normals = np.zeros((trees, inner, sample.shape[1]))
        self.splits = np.zeros((trees, inner))
        for t in range(trees):
            held = [np.arange(len(sample))]
            for node in range(inner):
                mine = sample[held[node]]
                tried = rng.normal(size=(DIRECTIONS, sample.shape[1]))
                tried /= np.linalg.norm(tried, axis=1)[:, None]
                at = mine @ tried.T
                best = int(at.std(0).argmax()) if len(mine) else 0
                self.normals[t, node] = tried[best]
                self.splits[t, node] = np.median(at[:, best]) if len(mine) else 0.0
                right = at[:, best] >= self.splits[t, node]
                held += [held[node][~right], held[node][right]]
                held[node] = None

    @property
    def leaves(self) -> int:
        return 2**self.depth

    def cells(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, numbered through the trees."""
        out = np.zeros((len(rows), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", rows, self.normals[t, node]) >= self.splits[t, node]
                node = 2 * node + 1 + side
            out[:, t] = node - (self.leaves - 1) + t * self.leaves
        return out

    def visits(self, query: np.ndarray):
        """The leaves of all trees, in the order in which one queue over all nodes gives them."""
        away = self.normals @ query - self.splits
        away = away.tolist()
        first = self.leaves - 1
        queue = [(0.0, t, 0) for t in range(self.trees)]
        while queue:
            penalty, t, node = heapq.heappop(queue)
            while node < first:  # down the near side
                over = away[t][node]
                near = 2 * node + 1 + (over >= 0)
                heapq.heappush(queue, (penalty + over * over, t, 4 * node + 3 - near))
                node = near
            yield t * self.leaves + node - first


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, kind).reshape(len(column), -1).astype(float) if len(column) else np.zeros((0, 1))


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part, each once."""
    v = F.col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < 1e150)) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & v.isNotNull() & whole).select(F.col(key).cast("long").alias("id"), v.alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return rows.where(F.size("vector") == (lengths[0]["length"] if lengths else 0))


def _packed(rows: DataFrame, kind: str):
    """The vectors as bytes, by Arrow."""

    def pack(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind)
            wide = values.reshape(batch.num_rows, -1) if batch.num_rows else values
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in wide], pa.binary())], ["id", "vector"])

    return rows.mapInArrow(lean(pack), "id long, vector binary")


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    once = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_PAIRS = "query_id long, vec_id long, score double"


def _pair_batch(query, row, far):
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(row), pa.array(far)], ["query_id", "vec_id", "score"])


def _truth(rows: DataFrame, probes: list[tuple[int, bytes]], k: int, kind: str) -> DataFrame:
    """The exact neighbours of a bounded number of queries, by one pass over all rows."""

    def scan(batches):
        ids = np.array([i for i, _ in probes], np.int64)
        q = _vectors(pa.array([v for _, v in probes], pa.binary()), kind)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for batch in batches:
            if batch.num_rows:
                new = nearest_pairs(q, ids, _vectors(batch.column(1), kind), batch.column(0).to_numpy(), k)
                found = least(*[np.concatenate(x) for x in zip(found, new)], k)
        yield _pair_batch(*found)

    return _ranked(rows.mapInArrow(lean(scan), _PAIRS), k)


def _measured(forest, rows: DataFrame, probes: list[tuple[int, bytes]], k: int, kind: str, recall: float) -> int:
    """The least number of visits that reach the share ``recall`` of the probes' true neighbours."""
    truth = materialise(_truth(rows, probes, k, kind), "neighbours")  # PROBES times k rows
    pairs = rows.join(F.broadcast(truth), F.col("id") == F.col("vec_id"))
    places: dict[int, list[int]] = {}
    for i, v in probes:
        order = np.empty(forest.trees * forest.leaves, np.int64)
        order[list(forest.visits(np.frombuffer(v, kind).astype(float)))] = np.arange(len(order))
        places.setdefault(i, []).append(order)
    need: dict[tuple[int, int], int] = {}
    for r in pairs.select("query_id", "vec_id", "vector").toLocalIterator():
        cells = forest.cells(np.frombuffer(bytes(r["vector"]), kind).astype(float)[None])[0]
        at = min(int(order[cells].min()) for order in places[r["query_id"]])
        pair = r["query_id"], r["vec_id"]
        need[pair] = min(at, need.get(pair, at))
    sorted_need = sorted(need.values())
    return 1 + sorted_need[min(len(sorted_need) - 1, int(np.ceil(recall * len(sorted_need))) - 1)] if sorted_need else 1


def _sizes(forest, rows: DataFrame, kind: str) -> np.ndarray:
    """Rows of each leaf."""

    def count(batches):
        sizes = np.zeros(forest.value.trees * forest.value.leaves, np.int64)
        for batch in batches:
            if batch.num_rows:
                sizes += np.bincount(forest.value.cells(_vectors(batch.column(1), kind)).ravel(), minlength=len(sizes))
        some = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sizes[some])], ["cell", "n"])

    out = np.zeros(forest.value.trees * forest.value.leaves, np.int64)
    for r in rows.mapInArrow(lean(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]  # a row for each leaf, at most TREES times 2 to DEEPEST
    return out


_SENT = "cell int, part int, asks boolean, id long, vector binary"


def _search(forest, rows: DataFrame, queries: DataFrame, sizes: np.ndarray, visits: int | None, k: int, kind: str, trees: int) -> DataFrame:
    """(query_id, vec_id, score) of the rows in the leaves that the queries visit; without ``visits`` in all of the
    first ``trees`` trees."""
    parts = np.maximum(1, -(-sizes // CHUNK))

    def sent(batch, at, cell, part, asks):
        n = len(at)
        body = batch.take(pa.array(at))
        return pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(part, pa.int32()), pa.array(np.full(n, asks)), body.column(0), body.column(1)], ["cell", "part", "asks", "id", "vector"])

    def put(batches):
        for batch in batches:
            if batch.num_rows:
                ids, cells = batch.column(0).to_numpy(), forest.value.cells(_vectors(batch.column(1), kind))
                for t in range(trees):
                    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                    yield sent(batch, np.arange(len(ids)), cells[:, t], (mixed % parts[cells[:, t]].astype(np.uint64)).astype(np.int32), False)

    def ask(batches):
        for batch in batches:
            for i, v in enumerate(_vectors(batch.column(1), kind)):
                if visits is None:
                    cells = np.arange(trees * forest.value.leaves)
                else:
                    cells = np.array([c for c, _ in zip(forest.value.visits(v), range(visits))])
                n = parts[cells]
                part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield sent(batch, np.full(n.sum(), i), np.repeat(cells, n), part, True)

    def meet(batches):
        at, ids, vectors = None, [], []
        held, size = [], 0
        for batch in batches:
            place = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
            asks, all_ids = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
            cuts = np.flatnonzero((place[1:] != place[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(place)]):
                if a == b:
                    continue
                wide = _vectors(batch.column(4).slice(a, b - a), kind)
                if not asks[a]:
                    if place[a] != at:
                        at, ids, vectors = place[a], [], []
                    ids.append(all_ids[a:b])
                    vectors.append(wide)
                elif place[a] == at:
                    if len(ids) > 1:
                        ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    held.append(nearest_pairs(wide, all_ids[a:b], vectors[0], ids[0], k))
                    size += len(held[-1][0])
                if size > _HELD:
                    held = [least(*[np.concatenate(x) for x in zip(*held)], k)]
                    size = len(held[0][0])
                    if size > _HELD // 2:
                        yield _pair_batch(*held[0])
                        held, size = [], 0
        if held:
            yield _pair_batch(*least(*[np.concatenate(x) for x in zip(*held)], k))

    both = rows.mapInArrow(lean(put), _SENT).unionByName(queries.mapInArrow(lean(ask), _SENT))
    return both.repartition("cell", "part").sortWithinPartitions("cell", "part", "asks").mapInArrow(lean(meet), _PAIRS)


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, trees: int = TREES, recall: float = 0.97) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row of which ``is_query`` (of key ``id``) holds."""
    spark, kind = vectors.sparkSession, {"double": "<f8"}.get(vectors.schema[vector].dataType.elementType.typeName(), "<f4")
    usable = _usable(vectors, key, vector)
    queries = materialise(_packed(usable.where(is_query).distinct(), kind), "queries")
    copies = Window.partitionBy("vector").orderBy("id")
    rows = usable.distinct().withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "vector")
    rows = materialise(_packed(rows, kind), "vectors")
    n = rows.count()
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return nothing
    drawn = rows.where(F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 20)) < F.lit(int(min(1.0, SAMPLE / n) * (1 << 20))))
    sample = _vectors(pa.array([bytes(r["vector"]) for r in (drawn.select("vector").collect() or rows.select("vector").take(1))], pa.binary()), kind)
    depth = int(np.clip(np.round(np.log2(max(1, n / LEAF))), 0, DEEPEST))
    forest = spark.sparkContext.broadcast(Forest(sample, trees, depth))
    probes = [(r["id"], bytes(r["vector"])) for r in queries.orderBy(F.xxhash64("id"), "id", "vector").limit(PROBES).collect()]
    if not probes:
        return nothing
    visits = _measured(forest.value, rows, probes, k, kind, recall)
    sizes = _sizes(forest, rows, kind)
    found = materialise(_ranked(_search(forest, rows, queries, sizes, visits, k, kind, trees), k), "found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = materialise(queries.join(full, "id", "left_anti"), "short")
    if not short.take(1):
        return found
    rest = _ranked(_search(forest, rows, short, sizes, None, k, kind, 1), k)
    return found.join(full, F.col("query_id") == F.col("id"), "left_semi").unionByName(rest)
