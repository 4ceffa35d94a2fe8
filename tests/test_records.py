"""Feature files, offset maps and byte spans against plain Python."""

import hashlib
import random

from pyspark.sql import functions as F

from strandgraph.operators import markup, offsets, repair
from strandgraph.sources import features


def test_feature_file_reading(spark):
    text = "@node\n@valueType=str\n\nfirst\n\n-\n7-9,12\tx\\ty\nnext\n3\ta\\\\n\\n\n\n"
    rows = [("a", text), ("b", "@node\n\n"), ("c", "@node\n\n\n"), ("d", None)]
    got = features.read_nodes(spark.createDataFrame(rows, "part string, content string")).collect()
    want = {1: "first", 2: "", 3: "a\\n\n", 7: "x\ty", 8: "x\ty", 9: "x\ty", 12: "x\ty", 13: "next", 4: ""}
    assert sorted((r.node, r.value) for r in got if r.part == "a") == sorted([*want.items(), (3, "-")])
    assert [(r.node, r.value) for r in got if r.part != "a"] == [(1, "")]


def test_feature_file_round_trip(spark):
    rng = random.Random(2)
    rows = [(n, rng.choice(["", "x", "a\tb", "c\\n", "\n", "ḫa", None])) for n in rng.sample(range(1, 400), 250)] + [(None, "x")]
    values = spark.createDataFrame(rows, "node long, value string")
    for span in (1 << 16, 50):
        back = features.read_nodes(features.files(features.compact(values, span), {"node": ""}))
        assert sorted((r.node, r.value) for r in back.collect()) == sorted(r for r in rows if None not in r)
    assert features.compact(values.limit(0)).count() == 0


def test_offsets(spark):
    rng = random.Random(5)
    edits, points, want = [], [], {}
    for doc in range(12):
        at, shift, spots = 0, 0, []
        for _ in range(rng.randint(0, 6)):
            start = at + rng.randint(0, 4)
            end, new = start + rng.randint(0, 3), rng.randint(0, 4)
            if (start, end) == (start, start) and not new:
                new = 1
            spots.append((start, end, new))
            at = end + 1
        edits += [(doc, *s) for s in spots]
        for x in range(at + 5):
            shift, exact, moved = 0, True, None
            for start, end, new in spots:
                if start <= x < end:
                    moved, exact = start + shift, False
                    break
                if x >= end:
                    shift += new - (end - start)
            want[doc, x] = (x + shift if moved is None else moved, exact)
            points.append((doc, x))
    table = offsets.pieces(spark.createDataFrame(edits, "doc long, start long, end long, new_len int"), "doc")
    got = offsets.translate(spark.createDataFrame(points, "doc long, x long"), table, "doc", "x")
    assert {(r.doc, r.x): (r.moved, r.exact) for r in got.collect()} == want
    back = offsets.translate(got.where("exact").select("doc", "x", "moved").withColumnRenamed("moved", "y"), table, "doc", "y", "o")
    assert all(r.moved == r.x and r.exact for r in back.collect())


def test_spans(spark):
    whole = '<?xml version="1.0"?>\n<!-- a <b> -->\n<a x="1>2" y=\'é\'>é<b/><c>t<![CDATA[<z>]]></c></a>\n'
    rows = [(1, whole), (2, "<a><b></a></b>"), (3, "<a>"), (4, "</a>"), (5, "<a/>x"), (6, "<a/><b/>"), (7, "<a>1 < 2</a>"), (8, ""), (9, None)]
    got = markup.spans(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()
    assert {r.key: r.outcome for r in got if r.key > 1} == {2: "crossing", 3: "unclosed", 4: "stray_close", 5: "text_outside", 6: "second_root", 7: "stray_lt", 8: "no_root", 9: "no_root"}
    data = whole.encode()
    a, b, c = sorted((r for r in got if r.key == 1), key=lambda r: r.ord)
    assert (a.tag, a.depth, a.attrs) == ("a", 0, {"x": "1>2", "y": "é"}) and data[a.outer_start : a.outer_end].endswith(b"</a>")
    assert data[a.inner_start : a.inner_end] == "é<b/><c>t<![CDATA[<z>]]></c>".encode()
    assert b.self_closing and b.inner_start is None and data[b.outer_start : b.outer_end] == b"<b/>"
    assert data[c.inner_start : c.inner_end] == b"t<![CDATA[<z>]]>" and c.depth == 1


def test_balanced():
    assert markup.balanced("f (a (b) c) (d)") == "a (b) c" and markup.balanced("f (a (b) c) (d)", 11) == "d"
    assert markup.balanced(") x (y") is None and markup.balanced("") is None


def test_word_groups(spark):
    for line, want in (
        ("a b", ["a", " b"]),
        ("  a\t<x/> b ", ["  a", "\t<x/> b "]),
        ("<sGr>A <d>B C</d></sGr>-ḫa  <corr c='?'/>", ["<sGr>A <d>B C</d></sGr>-ḫa  <corr c='?'/>"]),
        ("a<x/>b <num> </num> c", ["a<x/>b", " <num> </num> c"]),
        ("", []),
        (" <x/> ", []),
    ):
        data = line.encode()
        assert [data[a:b].decode() for a, b in markup.word_groups(data)] == want
    rows = [(1, "a <lb/>"), (2, "<d>a</num>"), (3, "<d>a"), (4, "a < b"), (5, "<i>a</i>"), (6, "a</i>"), (7, "a<!-- b -->"), (8, None), (9, "</d>")]
    got = {r.key: (r.fault, r.groups) for r in markup.unmarked_words(spark.createDataFrame(rows, "id int, line string"), "id", "line").collect()}
    assert all(not groups for _, groups in got.values())
    assert [got[k][0] for k in range(1, 10)] == ["framing lb", "unbalanced num", "unclosed d", "stray_lt", "nested i", "nested i", "not_an_element", None, "unbalanced d"]


def test_prepared_edges(spark):
    shape = "key int, sha256 string, patches array<struct<old:binary,new:binary,reason:string>>"
    rule = "key int, sha256 string, fingerprint string, mechanical array<int>, recovery array<int>, events array<string>"
    data, patch = b"abc", [(b"x", b"y", "r")]
    sha = hashlib.sha256(data).hexdigest()
    texts = spark.createDataFrame([(1, data), (2, data), (3, data)], "id int, body binary")
    manifest = spark.createDataFrame([(1, sha, patch), (2, sha, []), (3, sha, None)], shape)
    prints = {r.key: r.f for r in manifest.select("key", repair.fingerprint(F.col("patches")).alias("f")).collect()}
    assert prints[1] == hashlib.sha256(b'[["eA==","eQ==","r"]]').hexdigest()
    policy = spark.createDataFrame([(1, sha, prints[1], [1], [], ["e"]), (2, sha, prints[2], None, None, ["e"]), (3, sha, "f", [], [], ["e"])], rule)
    got = {r.key: (r.status, r.content, r.recovery) for r in repair.prepared(texts, manifest, policy, "id", "body").collect()}
    assert got == {1: ("does not apply", None, None), 2: ("ok", data, []), 3: ("patches changed", None, None)}
    assert repair.prepared(texts, manifest, policy.limit(0), "id", "body").count() == 0
