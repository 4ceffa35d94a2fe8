"""Operators against small cases and plain-Python twins."""

import random

import pytest

from pyspark.sql import functions as F

from strandgraph.functions import parsers
from strandgraph.operators import align, ranges, stats, template


def twin_pairs(marks):
    """A state machine for one family: (index, state) of each range."""
    out, held = [], None
    for i, (line, opens) in enumerate(marks):
        begins = i == 0 or marks[i - 1][0] != line
        if held is not None and marks[held][0] != line and not (begins and not opens and held == i - 1):
            out.append((held, "open"))
            held = None
        if opens:
            if held is not None:
                out.append((held, "open"))
            held = i
        elif held is not None:
            out.append((held, "paired"))
            held = None
        else:
            out.append((i, "close"))
    if held is not None:
        out.append((held, "open"))
    return sorted(out)


def test_pairing_equals_a_state_machine(spark):
    rng, rows, want = random.Random(5), [], []
    for doc in range(150):
        line, marks = 0, []
        for _ in range(rng.randint(0, 12)):
            line += rng.random() < 0.3
            marks.append((line, rng.random() < 0.5))
        rows += [(doc, i, m[0], m[1]) for i, m in enumerate(marks)]
        want += [(doc, *x) for x in twin_pairs(marks)]
    df = spark.createDataFrame(rows, "doc int, i int, line int, op boolean")
    got = ranges.pair_ranges(df, ["doc"], "line", ["i"], F.col("op")).select("doc", "i", "state").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_coverage_equals_slot_sets(spark):
    rng, rows = random.Random(2), []
    for _ in range(300):
        lo, hi = rng.randint(1, 6), rng.randint(1, 6)
        rows.append((lo, hi, rng.random() < 0.5, rng.random() < 0.5))
    df = spark.createDataFrame(rows, "lo int, hi int, a boolean, b boolean")
    width = ranges.coverage(F.col("lo"), F.col("hi"), F.col("a"), F.col("b"))[2]
    for r in df.where("lo <> hi").select("*", width.alias("w")).collect():
        slots = set(range(min(r.lo, r.hi), max(r.lo, r.hi) + 1)) - ({r.lo} if r.a else set()) - ({r.hi} if r.b else set())
        assert r.w == len(slots)


def test_alignment_levels():
    level = lambda *a: align.align_line(*a)[:2]
    assert level(["a", "b"], ["𒀀", "𒀁"], False, {}) == (1, ["𒀀", "𒀁"])
    assert level(["MEŠ", "b"], ["𒈨", "𒌍", "𒀁"], False, {"MEŠ": "𒈨𒌍"}) == (3, ["𒈨𒌍", "𒀁"])
    assert level(["12", "b"], ["𒌋", "𒁹", "𒁹", "𒀁"], False, {}) == (4, ["𒌋𒁹𒁹", "𒀁"])
    assert level(["a", "x", "b"], ["𒀀", "▒", "▒", "𒀁"], True, {}) == (2, ["𒀀", "▒", "𒀁"])
    assert level(["a", "…"], ["𒀀", "𒀁"], True, {})[0] == 0  # a gap takes no glyph
    assert level(["a", "b"], ["𒀀", "▒", "𒀁"], True, {}) == (2, ["𒀀", "𒀁"])
    assert level(["x", "b"], ["𒀀", "𒀂", "𒀁"], True, {})[0] == 0
    assert level(["MEŠ", "b"], ["𒈨", "𒀁"], False, {"MEŠ": "𒈨𒌍"})[0] == 0  # equal counts must expand
    assert level(["MEŠ", "b"], ["𒈨", "𒌍", "▒", "𒀁"], True, {"MEŠ": "𒈨𒌍"}) == (3, ["𒈨𒌍", "𒀁"])
    assert align.untorn(["𒈨", "𒌍", "𒀁"], ["MEŠ", "a", "b"], {"MEŠ": "𒈨𒌍"}) == [None] * 3


def all_ways(points, readings, compounds):
    """Every way of dropping placeholders and giving points to readings, as lists of values; by recursion."""
    out = []

    def go(i, j, values, used):
        if i == len(points) and j == len(readings):
            if compounds is None or used == {"drop", "compound"}:
                out.append(values)
            return
        if i < len(points) and points[i] == align.PLACEHOLDER:
            go(i + 1, j, values, used | {"drop"})
        if j < len(readings):
            if compounds is not None and readings[j] == align.GAP:
                go(i, j + 1, [*values, None], used)
            if i < len(points) and align.fits(readings[j], points[i]):
                go(i + 1, j + 1, [*values, points[i]], used)
            whole = (compounds or {}).get(readings[j])
            if whole and points[i : i + len(whole)] == list(whole):
                go(i + len(whole), j + 1, [*values, whole], used | {"compound"})

    go(0, 0, [], set())
    return out


def test_unanimous_values_equal_all_ways():
    rng = random.Random(8)
    for _ in range(3000):
        points = [rng.choice(["𒀀", "𒀁", "▒", "▒"]) for _ in range(rng.randint(1, 6))]
        readings = [rng.choice(["a", "b", "x", "M", "…"]) for _ in range(rng.randint(1, 4))]
        for compounds in (None, {"M": "𒀀𒀁"}):
            ways = all_ways(points, readings, compounds)
            got = align.unanimous(points, readings, compounds)
            if not ways:
                assert got is None
                continue
            want = [{w[j] for w in ways} - {None} for j in range(len(readings))]
            assert got == [next(iter(v)) if len(v) == 1 else None for v in want]


def test_align_map_side(spark):
    df = spark.createDataFrame([(1, ["a"], ["𒀀"], False), (2, ["a"], ["𒀀", "𒀁"], False), (3, None, None, None)], "line_id int, readings array<string>, glyphs array<string>, damaged boolean")
    assert {r.line_id: r.level for r in align.align(df, {}).collect()} == {1: 1, 2: 0, 3: 0}


def test_parsers(spark):
    rows = [("Vs. II 1′", "pai- @ go @ {a → 3SG} @ I.1 @ ", "1 2a 3bR 1sg 4ab", 12), ("u. Rd. (?) 3", "②Ⓐ += kkan@OBPk@@ D", "1 AKK", 40), ("???", "a@b", None, 0)]
    got = spark.createDataFrame(rows, "ref string, rec string, sel string, n int").select(
        parsers.line_reference(F.col("ref")).alias("l"), parsers.analysis_record(F.col("rec")).alias("a"), parsers.selectors(F.col("sel")).alias("s"), parsers.numeral(F.col("n")).alias("n"), parsers.selection_kind(F.col("sel")).alias("k")
    ).collect()
    r = got[0]
    assert (r.l.surface, r.l.column, r.l.ln, r.l.prime, r.l.collabel, r.l.lnno) == ("Vs.", "II", 1, "′", "Vs. II", "1′")
    assert (r.a.lemma, r.a.gloss, r.a.stemclass, r.a.alts, r.a.field4_kind, r.a.ok) == ("pai-", "go", "I.1", {"a": "3SG"}, "stemclass", True)
    assert [(x["index"], x.base_alt, x.clitic_alt, x.group) for x in r.s] == [(1, "", "", ""), (2, "a", "", ""), (3, "b", "R", ""), (1, "", "", "sg"), (4, "ab", "", "")] and r.k == "analysis"
    assert r.n == "𒌋𒁹𒁹"
    assert (got[1].a.note, got[1].a.ok, got[1].a.control, got[1].a.clitic.lemma) == ("clitic-only", True, "②Ⓐ", "kkan") and got[1].k == "AKK" and got[1].n is None
    assert got[2].a.note == "base has 2 field(s)" and not got[2].a.ok and got[2].k == "none" and got[2].l.ln is None and got[2].l.collabel == ""


def test_template_splits_at_the_first_operator():
    root = template.parse("analysis lemma=wed=a-\n  sign\n/without/\n  cluster width>0\n/-/")[0]
    assert root.predicates == [("lemma", "=", "wed=a-")]
    assert [c.otype for c in root.children] == ["sign"] and [c.otype for c in root.without] == ["cluster"]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (9, 8)], "a long, b long")
    assert {r.id: r.label for r in stats.min_label_components(edges).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7}


def test_streaming_session_equals_batch(spark, tmp_path):
    from strandgraph.streaming import events

    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = events.tumbling(stream).writeStream.outputMode("complete").format("memory").queryName("tumbled").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(n) FROM tumbled").first()[0] == rows.count() and schema is not None


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_components_equal_union_find(spark):
    """Paths, rings and random graphs against union-find."""
    rng = random.Random(3)
    shapes = [[(i, i + 1) for i in range(1, 201)], [(1000 + i, 1000 + (i * 7 + 1) % 101) for i in range(101)], [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(180)]]
    edges = [e for s in shapes for e in s]
    label = {x: x for e in edges for x in e}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    got = {r.id: r.label for r in stats.min_label_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in label}
    assert stats.min_label_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", ["alignment_coverage", "alignment_gate", "alignment_projection"])
def test_each_line_is_aligned_once(spark, name):
    """A result's lines are aligned in one pass, with no join back to the lines."""
    from strandgraph.plans import registry

    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapIn") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["analysis_record_parse", "control_gate", "morphology_gate"])
def test_records_are_parsed_once_on_all_cores(spark, name):
    """The parts of a record are evaluated once (the joint is looked for, then cut at), and a small file is dealt out."""
    from strandgraph.plans import registry

    df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 1
    record = parsers.analysis_record(F.col("raw"))._jc.toString()
    assert record.count("[ \\t]*(?:\\+=") <= 3
