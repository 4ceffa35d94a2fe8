"""Audits on null keys, separators inside values, missing hashes; order helpers and the gazetteer against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strandgraph.operators import audit, gazetteer, ordered, sequences
from strandgraph.sources import corpus


@pytest.fixture(scope="module")
def nulls(spark):
    return spark.createDataFrame([(None, None), (None, "a"), (1, None), (2, "b")], "k int, m string")


def test_a_table_equals_itself(spark, nulls):
    once = nulls.where("m IS NULL OR k = 2")
    assert audit.bag_diff(nulls, nulls, ["k"]).count() == 0 and audit.bag_diff(nulls, nulls, ["k", "m"]).count() == 0
    assert {(r.k, r.status) for r in audit.snapshot_diff(once, once, "k", "m").collect()} == {(None, "same"), (1, "same"), (2, "same")}
    assert {r.kind for r in audit.delta(once, once, "k", "m").collect()} == {"unchanged"} and audit.delta(once, once, "k", "m").count() == 3
    n = once.select("k", F.lit(3).alias("n"))
    assert all(r.balanced for r in audit.conserved({"a": n, "b": n, "c": n}, "k").collect()) and audit.conserved({"a": n, "b": n}, "k").count() == 3
    assert audit.drift(once, once, "m").count() == 0
    p = spark.createDataFrame([(None, 1, "x"), (None, None, "y"), (1, 1, None)], "b int, p int, v string")
    assert all(r.differing == 0 for r in sequences.compare(p, p, "b", "p", "v").collect())


def test_differences_are_named(spark, nulls):
    other = spark.createDataFrame([(None, None), (2, "c"), (3, "d")], "k int, m string")
    assert {(r.k, r.n_a, r.n_b) for r in audit.bag_diff(nulls, other, ["k"]).collect()} == {(None, 2, 1), (1, 1, 0), (3, 0, 1)}
    once = nulls.where("m IS NULL OR k = 2")
    assert {(r.k, r.status) for r in audit.snapshot_diff(once, other, "k", "m").collect()} == {(None, "same"), (1, "missing"), (2, "altered"), (3, "unexpected")}
    assert {(r.k, r.kind) for r in audit.delta(once, other, "k", "m").collect()} == {(None, "unchanged"), (1, "withdrawn"), (2, "replaced"), (3, "added")}
    assert {(r.m, r.status) for r in audit.drift(nulls, other, "m").collect()} == {("a", "undeclared"), ("b", "undeclared"), ("c", "unobserved"), ("d", "unobserved")}


def test_different_rows_have_different_digests(spark):
    tables = [[("a|b", "c")], [("a", "b|c")], [("a", None)], [("a", "~")], [("a", "-")], [("a", "")], [("", "a")], [(None, "a")], [("1:a", "")], [("a", "1:")]]
    digests = [audit.fingerprint(spark.createDataFrame([(1, *r) for r in t], "k long, a string, b string"), "k", ["a", "b"], []).first().digest for t in tables]
    assert len(set(digests)) == len(tables)


def test_lock_list(spark):
    sha = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    files = spark.createDataFrame([("a", b"abc"), ("b", b"abc"), ("c", b"x"), (None, b"abc"), ("e", b"abc"), ("n", None)], "src_file string, content binary")
    lock = spark.createDataFrame([("a", sha.upper()), ("b", None), ("c", sha), (None, sha), ("d", sha), ("n", sha)], "src_file string, sha256 string")
    got = {r.src_file: r.status for r in corpus.verified(files, lock).collect()}
    assert got == {"a": "ok", "b": "unlocked", "c": "altered", None: "ok", "d": "missing", "e": "unexpected", "n": "altered"}


def test_gates_run_when_asked(spark):
    mark, bad = spark.range(3).agg(F.count("*").alias("n")), spark.range(2)
    assert sorted(map(tuple, audit.gates([("a", bad), ("b", bad.limit(0))], mark, mark).collect())) == [("a", False, 2), ("b", True, 0)]
    moved = audit.gates([("b", bad.limit(0))], mark, spark.range(4).agg(F.count("*").alias("n")))
    assert [tuple(r) for r in moved.collect()] == [("b", False, 0)]
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    audit.gates([("a", bad)], mark, mark)
    assert tracker.getJobIdsForGroup(None) == before


def test_report_lines_has_a_bound(spark):
    with pytest.raises(ValueError, match="more than 5"):
        corpus.report_lines(spark.range(6), "t", 5)
    assert len(corpus.report_lines(spark.range(5), "t", 5)) == 9


@pytest.mark.parametrize("groups", [1, 5])
def test_order_in_groups_of_any_size(spark, groups):
    rng = random.Random(groups)
    rows = [(rng.choice([None, *range(groups)]), k, rng.randint(-3, 3)) for k in rng.sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "g int, k int, v int").repartition(7)
    by: dict = {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        by.setdefault(g, []).append((k, v))
    want_next = {k: (xs[i + 1] if i + 1 < len(xs) else None) for xs in by.values() for i, (k, _) in enumerate(xs)}
    want_sum = {k: sum(v for _, v in xs[: i + 1]) for xs in by.values() for i, (k, _) in enumerate(xs)}
    got = ordered.following(df, ["g"], ["k"], ["k", "v"]).collect()
    assert {r.k: None if r.next is None else tuple(r.next) for r in got} == want_next and len(got) == 900
    assert {r.k: r.s for r in ordered.running_sum(df, ["g"], ["k"], "v", "s").collect()} == want_sum


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_gazetteer_finds_edits_anywhere(spark, most):
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 6)))
    tokens, entries = [word() for _ in range(60)] + [None], [word() for _ in range(40)] + [None, "abcabcabc"]
    got = {tuple(r) for r in gazetteer.fuzzy(spark.createDataFrame([(t,) for t in tokens], "t string"), spark.createDataFrame([(e,) for e in entries], "e string"), "t", "e", most).collect()}
    assert got == {(t, e, distance(t, e)) for t in tokens if t is not None for e in entries if e is not None and distance(t, e) <= most}
