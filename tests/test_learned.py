"""Style, ranker and reuse: against numpy, on words that weren't learned from, and against all pairs."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strandgraph.operators import ranking, reuse, style
from strandgraph.plans import learned, registry

SF = "/root/testdata/sf0.001"


def test_char_ngrams(spark):
    df = spark.createDataFrame([("ab 𒀀d",), ("a\n\t b",), ("ab",), (None,)], "t string")
    got = [r.g for r in df.select(style.char_ngrams(F.col("t"), 3, 4).alias("g")).collect()]
    assert got == [["ab ", "b 𒀀", " 𒀀d", "ab 𒀀", "b 𒀀d"], ["a b"], [], []]


def test_counts_equal_hashing_tf(spark):
    """Counts by bucket are those of Spark's own hashing of the n-grams, which are made once and written."""
    from pyspark.ml.feature import HashingTF

    rows = [(0, "ab 𒀀d\n\té€x"), (1, None), (2, "ab"), (3, "zażółć gęślą " * 20), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id BETWEEN 5 AND 60"))
    grams = docs.select("doc_id", style.char_ngrams(F.col("text")).alias("g"))
    want = HashingTF(numFeatures=300, inputCol="g", outputCol="c").transform(grams).select("doc_id", vector_to_array("c").alias("c")).collect()
    got = {r.doc_id: dict(zip(r.at, r.n)) for r in style.counted(docs, "doc_id", "text", buckets=300).collect()}
    assert len(want) > 50 and all(got[r.doc_id] == {i: n for i, n in enumerate(r.c) if n} for r in want)


def test_style_against_numpy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    weighted = style.vectors(docs, "doc_id", "text", buckets=256).cache()
    x = np.array([r.w for r in weighted.orderBy("doc_id").select(vector_to_array("weights").alias("w")).collect()])
    norms = np.linalg.norm(x, axis=1)
    assert np.all(np.isclose(norms, 1) | (norms == 0)) and x.shape[1] == 256
    places = style.reduced(weighted, "doc_id", 10).cache()
    got = np.array([r.p for r in places.orderBy("doc_id").select(vector_to_array("place").alias("p")).collect()])
    centred = x - x.mean(0)
    _, _, v = np.linalg.svd(centred, full_matrices=False)
    want = x @ v[:10].T
    far = lambda m: np.linalg.norm(m[:, None] - m[None], axis=2)
    assert np.allclose(far(got), far(want), atol=1e-6)
    a, b = (style.clusters(places, "doc_id", 4).orderBy("doc_id").collect() for _ in range(2))
    assert a == b and len({r.cluster for r in a}) == 4 and len(a) == len(x)
    for r, p in zip(a, got):
        assert r.distance == pytest.approx(min(np.linalg.norm(p - got[[i for i, q in enumerate(a) if q.cluster == c]].mean(0)) for c in {r.cluster}), abs=1e-3)


def test_style_parts_languages(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet", columns=["doc_id", "lang"]).set_index("doc_id").lang
    got = registry.QUERIES["style_clusters"](spark, SF).toPandas()
    assert len(got) == len(docs)
    got["lang"] = got.doc_id.map(docs)
    got = got.dropna()
    major = got.groupby("cluster").lang.agg(lambda s: s.value_counts().iloc[0]).sum() / len(got)
    assert major > got.lang.value_counts().iloc[0] / len(got) + 0.2


def test_ranker_beats_the_base_rate_on_held_out_words(spark):
    got = registry.QUERIES["candidate_choice"](spark, "/root/testdata/sf0.01").toPandas()
    frame = learned.choices(spark, "/root/testdata/sf0.01").where(ranking.held_out(F.col("conv_id"))).toPandas()
    assert got.conv_id.is_unique and set(got.conv_id) == set(frame.conv_id)
    base = frame.groupby("conv_id").chosen.mean().mean()
    assert got.chosen.mean() > base + 0.2


def test_ranker_with_nulls_ties_and_unseen_kinds(spark):
    rows = [(w, c, float(c == w % 3), "a" if c == 0 else "b", c == w % 3) for w in range(60) for c in range(3)]
    model = ranking.fit(spark.createDataFrame(rows, "w int, c int, x double, k string, y boolean"), "y", ["x"], ["k"])
    new = spark.createDataFrame([(1, 0, None, None), (1, 1, 1.0, "zzz"), (2, 1, None, "b"), (2, 0, None, "b")], "w int, c int, x double, k string")
    assert {r.w: r.c for r in ranking.best(model, new, "w", "c", ["x"], ["k"]).collect()} == {1: 1, 2: 0}


def sets(rows, k=3):
    return {i: {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} for i, w in rows if w is not None and len(w) >= 10}


def test_index_against_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        w = [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(5, 60))]
        rows += [(10 * i, w), (10 * i + 1, w[: len(w) // 2] + [f"v{rng.randint(0, 9)}" for _ in range(10)])] + ([(10 * i + 2, w)] if i % 5 == 0 else [])
    rows += [(9999, None), (9998, [])]
    found, members = reuse.similar(spark.createDataFrame(rows, "k int, w array<string>"), "k", "w")
    have = sets(rows)
    first = {}
    for i in sorted(have):
        first.setdefault(frozenset(have[i]), i)
    assert {r.key: r["class"] for r in members.collect()} == {i: first[frozenset(s)] for i, s in have.items()}
    one = sorted(first.values())
    want = {(a, b): len(have[a] & have[b]) / len(have[a] | have[b]) for a in one for b in one if a < b}
    want = {p: j for p, j in want.items() if j >= 0.25}
    got = {(r.a, r.b): r.jaccard for r in found.collect()}
    assert set(got) <= set(want) and all(got[p] == pytest.approx(want[p]) for p in got) and len(got) >= 0.99 * len(want) > 20


def test_index_sets_travel_with_linked_pairs_only(spark, monkeypatch):
    """Texts that share a common line and nothing else cost no pairs; those that are half of it are all linked."""
    line = [f"l{i}" for i in range(12)]
    rows = [(i, line + [f"w{i}-{j}" for j in range(100)]) for i in range(200)] + [(1000 + i, line + [f"s{i}-{j}" for j in range(6)]) for i in range(8)]
    made, keep = {}, reuse.written
    monkeypatch.setattr(reuse, "written", lambda df, label: made.setdefault(label, keep(df, label)))
    found, _ = reuse.similar(spark.createDataFrame(rows, "k int, w array<string>"), "k", "w")
    pairs = {(r.a, r.b) for r in made["pairs"].collect()}
    assert {(r.a, r.b) for r in found.collect()} == pairs == {(a, b) for a in range(1000, 1008) for b in range(a + 1, 1008)}


def test_runs_against_brute_force(spark):
    rng = random.Random(4)
    a = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 30))]) for i in range(6)]
    b = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 30))]) for i in range(6)]
    want = set()
    for i, x in a:
        for j, y in b:
            for p in range(len(x)):
                for q in range(len(y)):
                    if x[p] == y[q] and (p == 0 or q == 0 or x[p - 1] != y[q - 1]):
                        n = 0
                        while p + n < len(x) and q + n < len(y) and x[p + n] == y[q + n]:
                            n += 1
                        if n >= 4:
                            want.add((i, j, p, q, n))
    got = reuse.runs(spark.createDataFrame(a, "i int, w array<string>"), spark.createDataFrame(b, "j int, w array<string>"), "i", "j", "w", 4)
    assert {tuple(r) for r in got.collect()} == want and len(want) >= 30
