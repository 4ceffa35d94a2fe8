"""Reverse-time merge and annulus clustering against brute force, with their edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from strandgraph.llm import annulus, queries, reverse_merge

EPOCH = datetime(1970, 1, 1)
SCHEMA = "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double"


def low(v):
    return (v is not None, v)


def brute(rows, hours=240):
    """Versions by replaying each client's changes forwards."""
    def when(r):
        moved = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        return (r[4] - EPOCH) // timedelta(microseconds=1) - (hours * 3600 * 10**6 if moved else 0)

    def cents(b):
        return None if b is None or b != b or abs(b) >= 9e16 else int(np.floor(100 * b + 0.5))

    clients = defaultdict(set)
    for r in rows:
        if r[4] is not None:
            clients[r[1]].add((r[0], when(r), r[3], *r[5:8], cents(r[8]), r[2]))
    out = []
    for client, mine in clients.items():
        by_seq = {}
        for r in mine:
            if r[2] in ("D", "I", "U") and (r[7] not in by_seq or tuple(map(low, r[:7])) > tuple(map(low, by_seq[r[7]][:7]))):
                by_seq[r[7]] = r
        by_time = {}
        for r in by_seq.values():
            if r[1] not in by_time or low(r[7]) > low(by_time[r[1]][7]):
                by_time[r[1]] = r
        state, found = None, []
        for t, r in sorted(by_time.items()):
            if r[2] == "D":
                new = (True, None, None, None, None)
            elif r[2] == "I" or state is None:
                new = (False, *r[3:7])
            else:
                new = (False, *[a if a is not None else b for a, b in zip(r[3:7], state[1:])])
            if new != state:
                found.append([t, *new, r[7]])
            state = new
        for i, f in enumerate(found):
            end = found[i + 1][0] if i + 1 < len(found) else None
            n = len({r[0] for r in mine if r[0] is not None and r[1] >= f[0] and (end is None or r[1] < end)})
            out.append((client, i + 1, f[0] // 10**6, None if end is None else end // 10**6, *f[1:7], n))
    return sorted(out, key=lambda r: tuple(map(low, r)))


def drawn(seed, n, clients, days, odd=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if odd and rng.random() < 0.02 else datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * days), microseconds=rng.choice([0, 0, 0, 250_000]) if odd else 0)
        some = lambda *xs: rng.choice([None, *xs])
        row = (rng.choice([i, i, rng.randrange(n), None]) if odd else i, rng.choice([*range(clients), None]) if odd else rng.randrange(clients), some(*range(n // 3)) if odd else rng.randrange(n // 3),
               rng.choice(["U", "U", "U", "U", "I", "D", *(["x", None] if odd else [])]), at, some("web", "crm"), some("retail", ""), some("Ilhav", "Portes"), some(1.005, -0.125, 12.0, *([float("nan"), float("inf"), 1e300] if odd else [])))
        rows += [row] * (2 if odd and rng.random() < 0.1 else 1)
    return rows


def got(df):
    return sorted((tuple(r) for r in df.select("client_id", "version", "valid_from", "valid_to", "is_deleted", "source", "segment", "city", "balance_cents", "first_seq", "n_changes").collect()), key=lambda r: tuple(map(low, r)))


@pytest.mark.parametrize("seed,span", [(1, 86_400), (2, 3600), (3, 86_400 * 400), (4, 7200)])
def test_versions_equal_a_forward_replay(spark, seed, span):
    rows = drawn(seed, 400, 3, 12)
    want = brute(rows)
    assert len(want) > 100 and got(reverse_merge.versions(spark.createDataFrame(rows, SCHEMA), span=span)) == want


def test_one_client_holds_all_rows(spark):
    rows = drawn(5, 1500, 1, 30, odd=False)
    assert got(reverse_merge.versions(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_merge_in_small_batches_and_clashing_columns(spark):
    rows = drawn(6, 300, 2, 3)
    df = spark.createDataFrame([(*r, 1, True) for r in rows], SCHEMA + ", span long, carried boolean").repartition(3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        assert got(reverse_merge.versions(df)) == brute(rows)
    finally:
        spark.conf.set(key, before)


def test_merge_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert reverse_merge.versions(empty).count() == 0
    timeless = spark.createDataFrame([(1, 1, 1, "I", None, "a", "b", "c", 1.0)], SCHEMA)
    assert reverse_merge.versions(timeless).count() == 0
    unknown = spark.createDataFrame([(1, 1, 1, None, datetime(2024, 1, 1), "a", "b", "c", 1.0)], SCHEMA)
    assert reverse_merge.versions(unknown).count() == 0


def test_merge_doesnt_depend_on_the_zone(spark):
    rows = drawn(7, 200, 2, 90, odd=False)
    want = brute(rows)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert got(reverse_merge.versions(spark.createDataFrame(rows, SCHEMA))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def lloyd(vectors, k, rounds, scale=64):
    """(id, cluster, distance), and the centroids, by comparing all of them in Python integers."""
    rows = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in vectors]
    first = sorted(rows, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())[:k]
    now = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        found = [(i, *min((far(v, c), n) for n, c in enumerate(now))[::-1], v) for i, v in rows]
        if turn < rounds:
            for n in range(len(now)):
                mine = [v for _, c, _, v in found if c == n]
                if mine:
                    now[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(f[:3] for f in found), now


@pytest.mark.parametrize("kind", ["sphere", "lattice", "scales"])
def test_clusters_equal_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    n, d = 400, 6
    if kind == "sphere":
        x = rng.normal(size=(n, d))
        x /= np.linalg.norm(x, axis=1)[:, None]
    elif kind == "lattice":  # many ties, in distance and in norm
        x = rng.integers(-1, 2, size=(n, d)) / 64
    else:
        x = rng.normal(size=(n, d)) * 10 ** rng.uniform(-2, 5, size=n)[:, None]
    vectors = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    want, now = lloyd(vectors, 7, 3)
    rows = annulus.cluster(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), k=7, dims=d).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in rows) == want
    for r in rows:
        assert r.inertia == sum(w[2] for w in want) and r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, now[r.cluster])).encode()).hexdigest()


def test_annulus_leaves_centroids_out_and_none_that_matter():
    rng = np.random.default_rng(4)
    centroids = np.rint(rng.normal(size=(50, 4)) * 10 ** rng.uniform(0, 4, size=50)[:, None]).astype(np.int64)
    rows = np.rint(rng.normal(size=(2000, 4)) * 10 ** rng.uniform(0, 4, size=2000)[:, None]).astype(np.int64)
    search = annulus.Annulus(centroids)
    _, _, first, last = search.candidates(rows)
    assert (last - first).mean() < 25  # half of them
    all_far = ((rows[:, None] - centroids[None]) ** 2).sum(2)
    number, best = search.nearest(rows)
    assert (number == all_far.argmin(1)).all() and (best == all_far.min(1)).all()


def test_cluster_edge_cases(spark):
    good = [0.5, 0.25, -0.1]
    rows = [(1, good, "a"), (1, good, "a"), (2, None, "a"), (3, [0.5, None, 0.1], "b"), (4, [0.5, float("nan"), 0.1], None), (5, [0.5, float("inf"), 0.1], None), (6, [0.5], None), (7, [], None), (None, [1.0, 2.0, 3.0], None), (8, [3e9, 0.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, number string")
    found = annulus.cluster(df, dims=3).collect()
    assert sorted((str(r.vec_id), r.distance) for r in found) == [("1", 0), ("1", 0), ("None", 0)] and {r.cluster for r in found} == {0, 2}
    assert annulus.cluster(df.where("vec_id = 2"), dims=3).count() == 0 and annulus.cluster(df.limit(0), dims=3).count() == 0
    assert queries.op13_annulus_clusters(spark, "/root/testdata/sf0.001").count() == 500
