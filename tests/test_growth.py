"""What queries shuffle, and how often they run their Python, read off their plans; and their results on odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandgraph.operators import apparatus, reuse, signs, stats, style
from strandgraph.plans import registry
from strandgraph.sources import tables
from strandgraph.streaming import pairing

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_collocation_counts_hashes(spark):
    """pairs are counted by numbers, not by a row of two words for each place."""
    lines = spark.createDataFrame([(["x", "y", "x", "z"],), (["x", "y"],), ([],), (["x"],), (None,)], "ws array<string>")
    found = stats.collocations(lines, 3, 1)
    assert sorted((r.a, r.b, r.n) for r in found.collect()) == [("x", "x", 1), ("x", "y", 2), ("x", "z", 1), ("y", "x", 1), ("y", "z", 1)]
    assert "explode(flatten" not in plan(found) and "MapInArrow" in plan(found)


def test_only_shared_shingles_are_shuffled(spark):
    """a document's shingles meet those of the items before any shuffle of both."""
    for name in ("shingle_reuse", "reuse_jaccard"):
        assert not re.search(r"hashpartitioning\(doc_id#\d+L?, g#\d+, \d+\)", plan(registry.QUERIES[name](spark, SF))), name


def test_shingles_of_documents_of_one_id_count_once(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e"), (2, None), (3, "a b c d")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "a b c d e f"), (8, "a b c d e a b c d e")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = registry.QUERIES["shingle_reuse"](spark, str(tmp_path)).collect()
    assert sorted((r.item_id, r.doc_id, r.shared) for r in got) == [(7, 1, 2), (8, 1, 1)]


def test_blocks_take_texts_behind_the_join(spark):
    """texts go to their pairs as they are, not as arrays of words."""
    found = plan(registry.QUERIES["reuse_blocks"](spark, SF))
    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, g#\d+, \d+\)", found)
    assert not re.search(r"Project \[doc_id#\d+L?, regexp_extract_all", found)


def test_heaviest_terms_with_fewer_joined(spark):
    """terms that can't be among the heaviest are left out before the join; the heaviest stay the same."""
    rows = [(d, f"r{d}_{i}", 1 + (i % 9) * (d % 4)) for d in range(200) for i in range(d % 12)] + [(d, f"c{i}", 1 + (d * i) % 7) for d in range(200) for i in range(5) if (d + i) % 3] + [(None, "c1", 2)]
    counts = spark.createDataFrame(rows, "d long, t string, tf long")
    n = spark.createDataFrame([(201,)], "n long")
    top = lambda k: sorted(map(str, stats.top_k(stats.tfidf(counts, "d", "t", n, k), ["d"], [F.desc("weight"), F.asc("t")], 3).collect()))
    assert top(3) == top(None)
    assert stats.tfidf(counts, "d", "t", n, 3).count() < counts.count()
    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, term", plan(registry.QUERIES["tfidf"](spark, SF)))


def test_lines_are_rendered_where_they_stand(spark, tmp_path):
    """no row for a word; texts of one id are one document, null has no lines."""
    spark.createDataFrame([(1, "a  b\n\n c"), (2, None), (3, ""), (4, "x y"), (4, "p q\nr"), (None, "n")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.QUERIES["text_format"](spark, str(tmp_path))
    assert {(r.doc_id, r.line): r.rendered for r in found.collect()} == {(1, 1): "a/1 b/2 ", (1, 3): "c/1 ", (4, 1): "p/1 x/1 q/2 y/2 ", (4, 2): "r/1 ", (None, 1): "n/1 "}
    assert "posexplode(regexp_extract_all" not in plan(found)


def test_one_timer_for_all_waiting_marks():
    """a key that holds many marks is woken once, not for each of them."""

    class State:
        def __init__(self, value=None):
            self.value = value

        def get(self):
            return self.value

        def exists(self):
            return self.value is not None

        update = put = lambda self, value: setattr(self, "value", value)

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.timers = []

        def registerTimer(self, at):
            self.timers.append(at)

    reader = pairing.PairMarks(1000)
    reader.handle, reader.open = Handle(), State()
    reader.waiting = State([(at, at, 0, at % 2 == 1) for at in range(1, 101)])
    assert sum(map(len, reader._read((1,), 21))) == 10 and reader.handle.timers == [22]
    assert sum(map(len, reader._read((1,), 100))) == 40 and len(reader.handle.timers) == 1


def test_a_large_group_of_names_is_cut(spark, tmp_path):
    """the join is dealt out, also inside a group."""
    rows = [(i, f"n{i % 7}", "b", 1, "t") for i in range(600)] + [(1000, "x", None, 1, "t"), (1001, "x", None, 1, "t")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    found = registry.QUERIES["edit_distance"](spark, str(tmp_path))
    assert found.count() == found.distinct().count() == 600 * 599 // 2 and found.agg(F.sum("distance")).first()[0] == sum(i % 7 != j % 7 for i in range(600) for j in range(i))
    assert "SortMergeJoin" in plan(found) and found.select(F.spark_partition_id()).distinct().count() > 1


def test_pairs_of_an_order_are_dealt_out(spark):
    """no side of the join is held whole, and its parts are of a bounded number of rows."""
    found = plan(registry.QUERIES["cooccurrence_network"](spark, SF))
    assert "SortMergeJoin" in found and "REPARTITION_BY_NUM" in found
    assert tables.parts(spark.range(1000), 10) == 100


def test_repairs_are_made_once(spark):
    """the patches are written before their lanes are looked up."""
    assert "MapInArrow" not in plan(registry.QUERIES["repair_lanes"](spark, SF))


def test_signs_of_a_word_stay_with_it(spark):
    """words are cut into signs once, and only the lineitems' keys are shuffled."""
    found = plan(registry.QUERIES["marked_sign_roundtrip"](spark, SF))
    assert found.count("MapInArrow") == 1 and found.count("Exchange hashpartitioning") == 1
    words = spark.createDataFrame([(1, "a-b"), (2, None), (3, ""), (4, "<d>")], "k long, w string")
    got = {r.key: [(s.srcxml, s.after) for s in r.signs] for r in signs.listed(words, "k", "w", ["srcxml", "after"]).collect()}
    assert got == {1: [("a", "-"), ("b", "")], 2: [], 3: [], 4: [("<d>", "")]}


def test_join_statements_stay_with_their_block(spark):
    """a block is read once, and only the lineitems' keys are shuffled."""
    for name in ("apparatus_joins", "apparatus_entries"):
        found = plan(registry.QUERIES[name](spark, SF))
        assert found.count("MapInArrow") == 1 and found.count("Exchange hashpartitioning") == 1 and "Window" not in found, name


def test_join_statements_are_those_of_the_tokens(spark):
    pieces = ["<AO:TxtPubl>K 1 {€1}</AO:TxtPubl>", " + ", "<AO:DirectJoin/>", "<AO:Other/>", "<AO:InvNr>K 1</AO:InvNr>", " (+) ", " ++ "]
    blocks = [(i, "<b>" + "".join(pieces[(i // 7**j) % 7] for j in range(4)) + "</b>") for i in range(7**4)] + [(-1, "<b>"), (-2, None)]
    df = spark.createDataFrame(blocks, "k long, t string")
    found = apparatus.tokens(df, "k", "t")
    labels = {(r.key, r.ord): r.value for r in found.where("kind = 'entry'").collect()}
    want = [(r.key, r.ord, r.join, r.mark, labels.get((r.key, r.left)), labels.get((r.key, r.right)), r.resolved) for r in apparatus.statements(found).collect()]
    got = [(r.key, r.ord, r.join, r.mark, r.left, r.right, r.resolved) for r in apparatus.joins(df, "k", "t").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 1000
    entries = [(r.key, r.ord, r.label, r.kind, r.siglum, r.source) for r in apparatus.entries(df, "k", "t").collect()]
    assert sorted(entries) == sorted((r.key, r.ord, r.value, r.encoding, r.siglum, r.siglum_source) for r in found.where("kind = 'entry'").collect())


def test_style_covariance_is_summed_by_few_tasks(spark, monkeypatch):
    """weights are made from the counts as they are read, not written, and no task hands on a matrix for each file."""
    labels, keep = [], style.written
    monkeypatch.setattr(style, "written", lambda df, label: labels.append(label) or keep(df, label))
    texts = [f" {'ab ' * (i % 5)}\u00e9\t\n zó{i} x{i % 7}\n " for i in range(90)] + [None, "", " ", "  \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(60)
    weighted = style.vectors(docs, "k", "t", buckets=64)
    x = np.zeros((len(texts), 64))
    for r in weighted.collect():
        x[r.k, r.at] = r.w
        assert np.array_equal(x[r.k], r.weights.toArray())
    assert np.allclose(style._covariance(weighted, 64), np.cov(x.T), atol=1e-12)
    assert style.reduced(weighted, "k", 4, 64).count() == len(texts) and labels == ["ngrams", "places"]
    found = plan(weighted.select("at", "w").coalesce(2 * spark.sparkContext.defaultParallelism))
    assert "Coalesce" in found and "ArrowEvalPython" not in found and "BatchEvalPython" not in found


def test_ngrams_of_texts_that_are_read_together(spark, monkeypatch):
    """a text's counts don't depend on its neighbours, nor on how many are hashed together."""
    texts = [" a ", " b", "\t", "", "zażółć  gęślą ", "\U00012000\U00012000 \U00012000", "ab", "c\x0bd\x1ce\u00a0f", "long text " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    got = {}
    for size in (1, 40, 1 << 16):
        monkeypatch.setattr(style, "PIECE", size)
        got[size] = {r.k: (r.at, r.n) for r in style.counted(docs, "k", "t", buckets=2048).collect()}
    assert got[1] == got[40] == got[1 << 16]
    grams = docs.select("k", F.explode(style.char_ngrams(F.col("t"))).alias("g")).groupBy("k").agg(F.count("*").alias("n")).collect()
    assert {r.k: r.n for r in grams} == {k: sum(n) for k, (_, n) in got[1].items() if n}


def families(seed, n, of):
    """Texts of a few families, each made of words of its own template in long stretches, and some copies."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        f, w = i % of, []
        while len(w) < 40:
            at = rng.randrange(80)
            w += [f"f{f}-{j}" for j in range(at, at + 12)] + [f"w{rng.randrange(400)}"] * rng.randrange(3)
        rows += [(10 * i, w)] + ([(10 * i + 1, w)] if i % 9 == 0 else [])
    return rows


@pytest.mark.parametrize(("many", "block"), [(2, 4), (8, 16), (64, 2048)])
def test_reuse_by_blocks_against_all_pairs(spark, monkeypatch, many, block):
    """links are the same, whether pairs or blocks of sets meet, and however small the blocks are."""
    monkeypatch.setattr(reuse, "MANY", many)
    monkeypatch.setattr(reuse, "BLOCK", block)
    rows = families(1, 150, 3) + [(9990, None), (9991, []), (9992, ["a"] * 9), (9993, ["a"] * 10), (9994, ["a"] * 30), (None, ["b"] * 12)]
    found, members = reuse.similar(spark.createDataFrame(rows, "k int, w array<string>").repartition(7), "k", "w")
    have = {i: frozenset(tuple(w[j : j + 3]) for j in range(len(w) - 2)) for i, w in rows if w and len(w) >= 10}
    first = {}
    for i in sorted(have, key=lambda x: (x is None, x)):
        first.setdefault(have[i], i)
    assert {r.key: r["class"] for r in members.collect()} == {i: first[s] for i, s in have.items()}
    one = [i for i in first.values() if i is not None]
    want = {(a, b): len(have[a] & have[b]) / len(have[a] | have[b]) for a in one for b in one if a < b}
    want = {p: j for p, j in want.items() if j >= 0.25}
    got = [(r.a, r.b, r.jaccard) for r in found.collect()]
    assert len(got) == len(want) > 500 and all(want[a, b] == j for a, b, j in got)


def test_reuse_of_a_large_family_makes_no_pairs(spark, monkeypatch):
    """sets are neither written whole for every text nor sent with each pair; those of a family meet in blocks."""
    made, keep = {}, reuse.written
    monkeypatch.setattr(reuse, "written", lambda df, label: made.setdefault(label, keep(df, label)))
    line = [f"l{i}" for i in range(60)]
    rows = [(i, line + [f"w{i}-{j}" for j in range(i % 20)]) for i in range(300)] + [(1000 + i, [f"x{i}-{j}" for j in range(50)]) for i in range(300)]
    found, _ = reuse.similar(spark.createDataFrame(rows, "k int, w array<string>"), "k", "w")
    classes = 300 - 14  # 15 of the family have nothing of their own
    assert found.count() == found.select("a", "b").distinct().count() == classes * (classes - 1) // 2
    assert made["pairs"].count() == 0 and made["met"].count() < 3000
    assert [f.dataType.typeName() for f in made["sets"].schema] == ["integer", "long", "integer"] and made["whole"].count() == classes


def test_shared_runs_as_products_or_pair_by_pair():
    rng = np.random.default_rng(1)
    for na, nb, n in ((1, 1, 1), (5, 3, 40), (60, 70, 3000), (200, 1, 5)):
        a, b = rng.random((na, n)) < np.linspace(0, 1, n) ** 4, rng.random((nb, n)) < np.linspace(0, 1, n) ** 4
        assert np.array_equal(reuse._shared(*np.nonzero(a), *np.nonzero(b), (na, nb)), a.astype(int) @ b.T.astype(int))
