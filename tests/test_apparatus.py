"""Apparatus blocks by literal cases, and coverage of open-ended ranges against explicit slots."""

import random

import pytest

from strandgraph.operators import apparatus, ranges


def parsed(inner):
    return apparatus.parse(f'<AO:Manuscripts xmlns:AO="x">{inner}</AO:Manuscripts>'.encode())


def entries(inner):
    return [(t["value"], t["encoding"], t["candidates"], t["sources"]) for t in parsed(inner) if t["kind"] == "entry"]


def shape(inner):
    return [(t["kind"][0], t["value"] if t["kind"] != "separator" else t["join"]) for t in parsed(inner)]


@pytest.mark.parametrize(
    ("inner", "wanted"),
    [
        ("<AO:TxtPubl>A</AO:TxtPubl><AO:DirectJoin/><AO:InvNr>B</AO:InvNr>", [("e", "A"), ("s", "direct"), ("e", "B")]),
        ("<AO:TxtPubl>A</AO:TxtPubl> + <AO:InvNr>B</AO:InvNr>(+)<x/> (+) ", [("e", "A"), ("s", "direct"), ("e", "B"), ("s", "indirect"), ("b", "x"), ("b", "(+)")]),
        ("KBo 1 + KBo 2 + KBo 3", [("e", "KBo 1"), ("s", "direct"), ("e", "KBo 2"), ("s", "direct"), ("e", "KBo 3")]),
        ("KBo 24.129 +", [("b", "KBo 24.129"), ("s", "direct")]),
        ("KBo 31.5++", [("b", "KBo 31.5"), ("s", "direct-multi")]),
        ("KBo 52.108(+)(+)", [("b", "KBo 52.108"), ("s", "indirect-multi")]),
        ("KBo 1 {€1} +", [("e", "KBo 1"), ("s", "direct")]),
        ("KUB 47.90+ {€3}", [("e", "KUB 47.90+")]),
        ("KUB 1 {€3}+ KUB 2 {B1}", [("e", "KUB 1"), ("s", "direct"), ("e", "KUB 2")]),
        ("<AO:TxtPubl>A</AO:TxtPubl>{€1} (+", [("e", "A"), ("s", "malformed")]),
        ("<AO:TxtPubl>A</AO:TxtPubl># KBo + x", [("e", "A"), ("b", "# KBo + x")]),
        ("{€1} + <AO:TxtPubl/>", [("b", "{€1}"), ("s", "direct"), ("e", "")]),
        ("<AO:TxtPubl>A {€1} + B {€1}</AO:TxtPubl>", [("e", "A"), ("s", "direct"), ("e", "B")]),
        ("<AO:TxtPubl>A</AO:TxtPubl>(+) ? <AO:TxtPubl>B</AO:TxtPubl>", [("e", "A"), ("s", "uncertain"), ("e", "B")]),
        ("", []),
        (" \n ", []),
    ],
)
def test_shapes(inner, wanted):
    assert shape(inner) == wanted


def test_sigla_and_where_they_come_from():
    assert entries('<AO:TxtPubl nr="€ 1">A</AO:TxtPubl>') == [("A", "txtpubl", ["€1"], ["attr"])]
    assert entries("<AO:InvNr>A</AO:InvNr> {€ 2}") == [("A", "invnr", ["€2"], ["tail"])]
    assert entries('<AO:TextPubl nr="€2">A {€1}</AO:TextPubl>') == [("A", "txtpubl", ["€1", "€2"], ["element-text", "attr"])]
    assert entries('<AO:TxtPubl nr="€2">A {€1} + B {€2}</AO:TxtPubl>') == [("A", "txtpubl", ["€1"], ["element-text"]), ("B", "txtpubl", ["€2"], ["element-text"])]
    assert entries('<AO:TxtPubl nr="€9">A + B</AO:TxtPubl>') == [("A", "txtpubl", [], []), ("B", "txtpubl", [], [])]
    assert entries("A &amp; B {7}") == [("A & B", "plain", ["7"], ["plain-text"])]


def test_statements_and_faults(spark):
    blocks = [(1, "<M><TxtPubl>A</TxtPubl> + (+) <TxtPubl>B</TxtPubl><x/><DirectJoin/><InvNr>C</InvNr>++<InvNr>D</InvNr></M>"), (2, "<M><a></M>"), (3, None)]
    found = apparatus.tokens(spark.createDataFrame(blocks, "k long, t string"), "k", "t")
    assert {(r.key, r.fault) for r in found.where("fault IS NOT NULL").collect()} == {(2, "crossing"), (3, "no_root")}
    got = [tuple(r)[1:] for r in apparatus.statements(found).orderBy("ord").collect()]
    assert got == [(2, "direct", "+", 1, 4, True), (3, "indirect", "(+)", 1, 4, True), (6, "direct", "DirectJoin", None, 7, False), (8, "direct-multi", "++", 7, 9, False)]
    assert apparatus.tokens(spark.createDataFrame(blocks, "k long, t string").limit(0), "k", "t").count() == 0


@pytest.mark.parametrize("strict", [False, True])
def test_coverage_equals_explicit_slots(spark, strict):
    rng = random.Random(6)
    slots, rows, want = [], [], {}
    length = {}
    for doc in range(40):
        first, n = rng.randint(1, 50), rng.choice([1, 1, 2, 5, 9])
        for s in range(first, first + n):
            length[doc, s] = rng.randint(0, 3)
            slots.append((doc, s, length[doc, s]))
        for _ in range(25):
            i = len(rows)
            a, b = (rng.choice([None, *range(first, first + n)]) for _ in range(2))
            ao, bo, orphan = rng.randint(0, 4), rng.randint(-1, 4), rng.choice(["none", "close", "open"])
            rows.append((i, doc, a, ao, b, bo, orphan))
            lo, hi = sorted((first if a is None else a, first + n - 1 if b is None else b))
            held = set(range(lo, hi + 1))
            if lo == hi and a == b:
                if ao >= bo:
                    held.clear()
            else:
                if a is not None and ao >= length[doc, a]:
                    held.discard(a)
                if b is not None and bo <= 0:
                    held.discard(b)
            if strict and orphan == "close" and a is None:
                held.clear()
            anchor = None if held else a if a is not None else b if b is not None else first
            want[i] = (min(held, default=None), max(held, default=None), len(held), anchor)
    spans = spark.createDataFrame(rows, "i int, doc int, start_sign int, start_offset int, end_sign int, end_offset int, orphan string")
    got = ranges.open_coverage(spans, spark.createDataFrame(slots, "doc int, slot int, length int"), "doc", strict).collect()
    assert {r.i: (r.lo, r.hi, r.width, r.anchor) for r in got} == want
    assert sum(w[2] == 0 for w in want.values()) > 100


def test_coverage_leaves_out_anchors_that_are_no_slot(spark):
    spans = spark.createDataFrame([(1, 9, 0, 9, 0, "none"), (2, 9, 0, 1, 0, "none"), (1, None, 0, None, 0, "none")], "doc int, start_sign int, start_offset int, end_sign int, end_offset int, orphan string")
    got = ranges.open_coverage(spans, spark.createDataFrame([(1, 3, 2), (1, 4, 2)], "doc int, slot int, length int"), "doc").collect()
    assert [(r.doc, r.lo, r.hi, r.width) for r in got] == [(1, 3, 4, 2)]
