"""Interval joins by buckets against all pairs, on keys long and short, and their plans."""

import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from strandgraph.operators import buckets, template


def drawn(seed, n, keys, most, length):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lo = rng.randrange(most)
        rows.append((i, rng.choice([*range(keys), None]), lo, lo + rng.choice([-1, 0, 1, rng.randrange(length), most // 2 if i % 17 == 0 else 3])))
    return rows


@pytest.mark.parametrize("width", [1, 7, 64, 4096])
def test_pairs_come_once_and_none_is_lost(spark, width):
    a, b = drawn(1, 150, 3, 300, 40), drawn(2, 200, 3, 300, 9)
    left, right = spark.createDataFrame(a, "x int, k int, lo int, hi int"), spark.createDataFrame(b, "y int, k int, p_lo int, p_hi int")
    pairs = [(p, q) for p in a for q in b if p[1] is not None and p[1] == q[1] and p[2] <= p[3]]
    inside = sorted((p[0], q[0]) for p, q in pairs if p[2] <= q[2] and q[3] <= p[3])
    meet = sorted((p[0], q[0]) for p, q in pairs if q[2] <= q[3] and p[2] <= q[3] and q[2] <= p[3])
    got = buckets.within(left, right.where("p_lo <= p_hi"), "k", width=width)
    assert sorted((r.x, r.y) for r in got.collect()) == sorted((x, y) for x, y in inside if b[y][2] <= b[y][3])
    assert sorted((r.x, r.y) for r in buckets.meeting(left, right, "k", width=width).collect()) == meet
    for overlaps, held in ((False, [(x, y) for x, y in inside if b[y][2] <= b[y][3]]), (True, meet)):
        none = {p[0] for p in a} - {x for x, _ in held}
        assert {r.x for r in buckets.lacking(left, right.where("p_lo <= p_hi"), "k", overlaps=overlaps, width=width).collect()} == none


@pytest.mark.parametrize("width", [1, 16, 4096])
def test_innermost_holder(spark, width):
    a, b = [r for r in drawn(3, 120, 2, 200, 60) if r[2] <= r[3]], [r for r in drawn(4, 200, 2, 220, 5) if r[2] <= r[3]]
    got = buckets.innermost(spark.createDataFrame(a, "n int, k int, lo int, hi int"), spark.createDataFrame(b, "n int, k int, p_lo int, p_hi int"), "k", "n", width).collect()
    assert len(got) == len(b)
    for r in got:
        _, k, lo, hi = next(q for q in b if q[0] == r.n)
        held = sorted((p[3] - p[2], -p[2], p[0]) for p in a if k is not None and p[1] == k and p[2] <= lo and hi <= p[3])
        assert r.holder == (held[0][2] if held else None)


def test_a_long_key_is_spread_over_tasks(spark):
    """A document of a million slots: the join's tasks see buckets, and its plan has no Exchange on the document alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    words = spark.range(250_000).select((F.col("id") * 0 + 1).alias("doc"), (F.col("id") * 4).alias("lo"), (F.col("id") * 4 + 3).alias("hi"))
    signs = spark.range(1_000_000).select((F.col("id") * 0 + 1).alias("doc"), F.col("id").alias("p_lo"), F.col("id").alias("p_hi"))
    joined = buckets.within(words, signs, "doc")
    out = io.StringIO()
    with redirect_stdout(out):
        joined.explain()
    exchanges = [line for line in out.getvalue().split("\n") if "Exchange hashpartitioning" in line]
    assert exchanges and all("floor" in x.lower() or "_b" in x or "_c" in x for x in exchanges)
    spread = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in spread) == 1_000_000 and max(r["count"] for r in spread) < 700_000


def test_slot_search_inside_one_long_document(spark):
    rng = random.Random(5)
    words = [(i, 1, 10 * i, 10 * i + rng.randint(0, 25), i % 3) for i in range(400)]
    signs = [(1000 + i, 1, i, i, rng.choice("ab")) for i in range(4000)]
    types = {"word": spark.createDataFrame(words, "node int, doc int, lo int, hi int, n int"), "sign": spark.createDataFrame(signs, "node int, doc int, lo int, hi int, kind string")}
    got = sorted((r.n0, r.n1) for r in template.search_slots("word n>1\n  sign kind=a", types).collect())
    assert got == sorted((w[0], s[0]) for w in words if w[4] > 1 for s in signs if s[4] == "a" and w[2] <= s[2] <= w[3])
    bare = {r.n0 for r in template.search_slots("word\n/without/\n  sign kind=a\n/-/", types).collect()}
    assert bare == {w[0] for w in words if not any(s[4] == "a" and w[2] <= s[2] <= w[3] for s in signs)}
