"""Repair, sequences, files, formats and audits against plain Python."""

import random
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from strandgraph.operators import align, audit, hierarchy, render, repair, sequences, stats
from strandgraph.plans import registry
from strandgraph.sources import corpus, features

SF = "/root/testdata/sf0.001"


def test_patches_lead_to_the_repaired_text():
    """Random damage: what parses after repair is what the patches make of the text, and only of that text."""
    rng = random.Random(4)
    damage = ['<w <w t="1"/>', '<w t="a <b"/>', '<w t="1" t="1"/>', '<w t="x"\' a="y"/>', "<k><w>x</k></w>", "</w>", '<w l="4"/1"/>', "<w>ok</w>", "text"]
    mended = 0
    for _ in range(400):
        data = ("<d>" + "".join(rng.choice(damage) for _ in range(rng.randint(0, 4))) + "</d>").encode()
        out, patches = repair.repair(data)
        assert repair.apply(data, patches) == out
        mended += repair.parses(out)
    assert mended > 250
    with pytest.raises(ValueError):
        repair.apply(b"<a>aa</a>", [(b"a", b"b", "")])
    with pytest.raises(ValueError):
        repair.apply(b"x", [], "0")
    assert repair.repair(b"") == (b"", []) and not repair.parses(b"")


def test_repair_of_null_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, "<a/>")], "k long, t string")
    got = {r.key: (r.ok, len(r.patches)) for r in repair.repaired(df, "k", "t").collect()}
    assert got == {1: (False, 0), 2: (True, 0)} and repair.repaired(df.limit(0), "k", "t").count() == 0


def test_opcodes_rebuild_the_other_sequence(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 9))], [rng.choice("abc") for _ in range(rng.randint(0, 9))]) for i in range(60)] + [(99, None, ["a"])]
    pairs = spark.createDataFrame(rows, "k long, a array<string>, b array<string>")
    ops = {}
    for r in sequences.opcodes(pairs, ["k"], "a", "b").collect():
        ops.setdefault(r.k, []).append(r)
    for k, a, b in rows:
        out, at = [], 0
        for r in sorted(ops.get(k, []), key=lambda r: r.ord):
            out += (a or [])[at : r.a_lo] + b[r.b_lo : r.b_hi]
            at = r.a_hi
        assert out + (a or [])[at:] == b
    found = {(r.k, r.a_at, r.b_at, r.size) for r in sequences.blocks(pairs, ["k"], "a", "b", 2).collect()}
    assert found == {(k, m.a, m.b, m.size) for k, a, b in rows for m in SequenceMatcher(None, a or [], b, autojunk=False).get_matching_blocks() if m.size >= 2}


def test_variants_and_blocks_of_the_tables(spark):
    """Rows of the two queries that SQL can't express, by hand."""
    rows = [r for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    groups = {}
    for r in rows:
        groups.setdefault(f"{r.conv_id}/{r.role}", []).append((r.turn, r.text.split(" ")))
    want = set()
    for g, items in groups.items():
        (k, a), *others = sorted(items)
        for o, b in others:
            ops = [x for x in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if x[0] != "equal"]
            want |= {(g, k, o, n, *x) for n, x in enumerate(ops)}
    assert {tuple(r) for r in registry.QUERIES["variant_diff"](spark, SF).collect()} == want
    assert all(r.size >= 5 for r in registry.QUERIES["reuse_blocks"](spark, SF).collect())


def test_corpus_scan(spark, tmp_path):
    """Files below a root by stable keys in the folded order, whatever form their names have."""
    for name in ("B/É.xml", "a/b c.xml", "a/z.xml", "a/z.txt", "C.xml"):
        p = tmp_path / unicodedata.normalize("NFD", name)
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(name.encode())
    files = corpus.scan(spark, f"file://{tmp_path}")
    got = {r.src_file: r.ordinal for r in corpus.ordinals(files.select("src_file")).collect()}
    assert got == {"a/b c.xml": 1, "a/z.xml": 2, "B/É.xml": 3, "C.xml": 4}
    assert {r.src_file: bytes(r.content) for r in files.collect()}["a/z.xml"] == b"a/z.xml"
    assert corpus.report_lines(spark.createDataFrame([(2, "b"), (1, "a")], "n long, s string"), "T") == ["# T", "", "| n | s |", "|-|-|", "| 1 | a |", "| 2 | b |"]


def test_edge_file_reading(spark):
    plain = "@edge\n\n1\t3-4\n5\n7\t2,9\n"
    valued = "@edge\n@edgeValues\n\n1\t3\tx\n4\ty\n1\t3\tz\n"
    read = lambda t, v: sorted((r.src, r.dst, r.value) for r in features.read_edges(spark.createDataFrame([("a", t)], "part string, content string"), "part", v).collect())
    assert read(plain, False) == [(1, 3, None), (1, 4, None), (2, 5, None), (7, 2, None), (7, 9, None)]
    assert read(valued, True) == [(1, 3, "z"), (2, 4, "y")]


def test_formats(spark):
    level, part = render.compiled("line#{cu/alt}: {n} ")
    assert level == "line" and render.compiled("{a}#{b}")[0] is None and render.fields("{a/b}-{c}") == ["a", "b", "c"]
    df = spark.createDataFrame([("x", None, 1), (None, "y", None)], "cu string, alt string, n int")
    assert [r[0] for r in df.select(part).collect()] == ["x: 1 ", "y:  "]


def test_quantile_equals_sorting(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.5, 7.0, None, rng.random()])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        for r in stats.quantile(df, "g", "v", q).collect():
            v = sorted(x for g, x in rows if g == r.g and x is not None)
            at = (len(v) - 1) * q
            want = v[int(at)] + (v[min(int(at) + 1, len(v) - 1)] - v[int(at)]) * (at - int(at))
            assert abs(r.quantile - want) < 1e-9


def test_anchored_gaps():
    single = {"a": "𒀀", "b": "𒀁"}
    assert align.anchored_gaps(["a", "M", "b"], list("𒀀𒈨𒌍𒀁"), single) == [("M", "𒈨𒌍")]
    assert align.anchored_gaps(["M"], list("𒈨𒌍"), single) == [("M", "𒈨𒌍")]
    assert align.anchored_gaps(["a", "M", "b"], list("𒀀𒈨▒𒀁"), single) == []
    assert align.anchored_gaps(["M", "N"], list("𒈨𒌍𒀁"), single) == []


def test_agreement_and_apparatus(spark):
    votes = [("i", "l1", "x"), ("i", "l1", "x"), ("i", "l2", "x"), ("i", "l3", None), ("j", "l1", "x"), ("j", "l1", "y"), ("j", "l2", "z"), ("k", "l1", None)]
    got = {r.item: tuple(r)[1:] for r in audit.agreement(spark.createDataFrame(votes, "item string, lin string, c string"), "item", "lin", "c").collect()}
    assert got == {"i": (3, 2, 0, 1, "x"), "j": (2, 1, 0, 1, "z"), "k": (1, 0, 0, 1, None)}
    tokens = [(1, 1, "entry", "A"), (1, 2, "separator", "+"), (1, 3, "separator", "(+)"), (1, 4, "entry", "B"), (1, 5, "barrier", "|"), (1, 6, "separator", "+"), (1, 7, "entry", "C")]
    found = hierarchy.apparatus(spark.createDataFrame(tokens, "b long, o long, kind string, value string"), ["b"], "o").orderBy("o").collect()
    assert [(r.left, r.right, r.resolved) for r in found] == [("A", "B", True), ("A", "B", True), (None, "C", False)]


def test_language_is_reset_by_a_null(spark):
    rows = [(1, 1, True, "x"), (1, 2, False, None), (1, 3, True, None), (1, 4, False, None)]
    df = spark.createDataFrame(rows, "d long, o long, e boolean, v string")
    held = hierarchy.active(F.col("e"), F.col("v"), ["d"], ["o"])
    assert [r[0] for r in df.select(held.alias("h"), "o").orderBy("o").collect()] == ["x", "x", None, None]


def test_ordinals_of_many_files_and_equal_names(spark):
    """Ranges are drawn from a sample; places are right where the rows are many more than that."""
    rows = spark.range(60000).select((F.col("id") * 7919 % 60000).alias("node"), F.lpad((F.col("id") % 20000).cast("string"), 6, "0").alias("name")).repartition(6)
    got = corpus.ordinals(rows, "name", ("node",)).toPandas().sort_values(["name", "node"])
    assert list(got.ordinal) == list(range(1, 60001))
