"""Nearest neighbours of the forest against brute force: recall, ties, copies, few rows and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandgraph.llm import forest, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=10):
    """query id -> [(row id, distance)] of the k nearest, in double precision."""
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in ok:
        if q % 100 == 0:
            near = out.setdefault(q, {})
            for i, b in ok:
                if i != q:
                    total = 0.0
                    for x, y in zip(a, b):
                        total += (x - y) * (x - y)
                    near[i] = min(near.get(i, np.inf), float(np.sqrt(total)))
    return {q: sorted(near.items(), key=lambda p: (p[1], p[0]))[:k] for q, near in out.items() if near}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def searched(spark, rows, **more):
    return found(forest.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0, **more))


def vectors(n, d, groups, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(groups, d))[rng.integers(0, groups, n)] * 3 + rng.normal(size=(n, d))
    return [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("groups", [1, 40])
def test_recall_and_scores(spark, monkeypatch, groups):
    monkeypatch.setattr(forest, "LEAF", 60)
    monkeypatch.setattr(forest, "CHUNK", 25)  # leaves in several parts
    rows = vectors(4000, 16, groups)
    got, want = searched(spark, rows), brute(rows)
    assert set(got) == set(want)
    exact = {q: dict(brute([(q, rows[q][1]), *[(i, rows[i][1]) for i, _ in got[q]]])[q]) for q in list(got)[:10]}
    for q, far in exact.items():
        assert dict(got[q]) == far  # the stated distances, to the bit
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.93 * sum(map(len, want.values()))


def test_fewer_visits_on_vectors_with_structure(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 60)
    seen = []
    measured = forest._measured
    monkeypatch.setattr(forest, "_measured", lambda *a: seen.append(measured(*a)) or seen[-1])
    for groups in (1, 40):
        searched(spark, vectors(4000, 16, groups))
    assert seen[1] < seen[0] / 2


def test_one_queue_gives_all_leaves_nearest_first():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(500, 8))
    trees = forest.Forest(sample, 3, 4)
    asked = rng.normal(size=(20, 8))
    for q, cells in zip(asked, trees.cells(asked)):
        order = list(trees.visits(q))
        assert sorted(order) == list(range(3 * 16)) and set(order[:3]) == set(cells.tolist())  # its own leaves have no penalty
    cells = trees.cells(sample)
    assert all(np.bincount(cells[:, t], minlength=48).max() < 60 for t in range(3))


def test_copies_ties_and_repeated_ids_are_exact(spark):
    same = [0.5, -1.0, 2.0]
    rows = [(i, same) for i in range(300)] + [(i, same) for i in range(150)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(30)] + [(1000, [7.0, 1.0, 0.0]), (700, [2.5, 1.0, 0.0])]
    got, want = searched(spark, rows), brute(rows)
    assert got == want
    assert [i for i, _ in got[0]] == list(range(1, 11)) and [i for i, _ in got[200]] == list(range(10)) and got[700][0][0] == 1002


def test_few_rows_give_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.0, 1.0]), (100, [1.0, 1.0]), (7, [2.0, 1.0])]
    assert searched(spark, rows) == brute(rows)
    assert searched(spark, rows[:1]) == {} and searched(spark, []) == {} and searched(spark, rows[1:2]) == {}


def test_short_queries_search_all_of_a_tree(spark, monkeypatch):
    """Leaves so small that one visit gives fewer than ten."""
    monkeypatch.setattr(forest, "LEAF", 4)
    monkeypatch.setattr(forest, "_measured", lambda *a: 1)
    rows = vectors(200, 4, 3)
    got, want = searched(spark, rows, trees=1), brute(rows)
    assert got == want


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 0.5]), (8, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (100, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", id int, vector string")
    assert {q: [i for i, _ in near] for q, near in found(forest.search(df, F.col("id") % 100 == 0)).items()} == {0: [8]}


def test_registered_search_is_exact_on_the_small_table(spark):
    import pandas as pd

    rows = list(pd.read_parquet("/root/testdata/sf0.001/embeddings.parquet", columns=["vec_id", "embedding"]).itertuples(index=False))
    got, want = found(queries.op11_forest_neighbours(spark, "/root/testdata/sf0.001")), brute(rows)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-15)
