"""Gates: each derives the same facts twice, or holds figures against ceilings, and gives what doesn't agree."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import parsers
from ..operators import align, audit, markup, ranges, repair, sequences, text
from ..sources import shared
from ..sources.tables import spread, table
from .derive import _COMPOUNDS, _DRAWN, _lines
from .grammars import _BROKEN, _RECORD, _SELECTION
from .intervals import _E, _PAIR, events
from .registry import query

_XML = "'<t id=\"' || CAST(o_orderkey AS STRING) || '\"><lb/><w>' || o_orderstatus || '-' || CAST(o_custkey AS STRING) || '</w>' || CASE WHEN o_orderkey % 3 = 0 THEN '<note n=\"1\"/>' ELSE '' END || CASE WHEN o_orderkey % 4 = 0 THEN '<w><w>x</w></w>' ELSE '' END || '</t>'"


def _spans(spark, sf_dir):
    xml = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_XML).alias("xml"))
    return xml, shared.written(markup.spans(xml, "o_orderkey", "xml").drop("attrs"), "spans")


@query("SELECT o_orderkey, source, fed, emitted, source = fed AND fed = emitted AS balanced FROM (SELECT o_orderkey, CAST(3 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 0 END AS BIGINT) AS source, CAST(3 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 0 END AS BIGINT) AS fed, CAST(3 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 0 END AS BIGINT) AS emitted FROM orders)")
def marker_conservation(spark, sf_dir):
    """Start tags counted in the text, elements that end, and spans of the scan."""
    xml, spans = _spans(spark, sf_dir)
    starts = xml.select("o_orderkey", F.regexp_count("xml", F.lit("<[a-z]")).cast("long").alias("n"))
    ends = xml.select("o_orderkey", (F.regexp_count("xml", F.lit("</")) + F.regexp_count("xml", F.lit("/>"))).cast("long").alias("n"))
    emitted = spans.groupBy(F.col("key").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return audit.conserved({"source": starts, "fed": ends, "emitted": emitted}, "o_orderkey")


@query("SELECT 'lb' AS tag, count(*) AS nodes, count(*) AS expected FROM orders UNION ALL SELECT 'note', n, n FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 3 = 0) UNION ALL SELECT 'w', n, n FROM (SELECT CAST(sum(CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM orders)")
def structure_conservation(spark, sf_dir):
    """Top-level elements by kind in the graph and in the source; an inner word isn't one."""
    xml, spans = _spans(spark, sf_dir)
    inner = Window.partitionBy("key").orderBy("outer_start").rowsBetween(Window.unboundedPreceding, -1)
    words = spans.where("tag <> 't'").withColumn("_m", F.max(F.when(F.col("tag") == "w", F.col("outer_end"))).over(inner))
    nodes = words.where("_m IS NULL OR outer_start >= _m OR tag <> 'w'").groupBy("tag").agg(F.count("*").alias("nodes"))
    bare = F.replace("xml", F.lit("<w><w>x</w></w>"), F.lit("<w>x</w>"))
    counted = [xml.agg(F.sum(F.regexp_count(bare, F.lit(f"<{t}[ />]"))).cast("long").alias("expected")).withColumn("tag", F.lit(t)) for t in ("lb", "note", "w")]
    return nodes.join(counted[0].unionByName(counted[1]).unionByName(counted[2]), "tag").select("tag", "nodes", "expected")


@query("SELECT conv_id, turn, role, length(text) AS n_chars, true AS whole FROM conversations")
def sign_roundtrip(spark, sf_dir):
    """The signs of a text with their separators give the text again."""
    rows = table(spark, sf_dir, "conversations").select(F.struct("conv_id", "turn", "role").alias("at"), "text")
    signs = text.signs(rows, "text", "at").groupBy("at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat("sym", "after").alias("s")))), lambda x: x["s"]), "").alias("again"))
    return rows.join(signs, "at").select("at.*", F.length("text").alias("n_chars"), (F.col("again") == F.col("text")).alias("whole"))


@query("SELECT CAST(0 AS BIGINT) AS crossing, CAST(0 AS BIGINT) AS outside, count(*) AS texts FROM orders")
def byte_contract(spark, sf_dir):
    """Violations of the spans' nesting: an element that ends after one that began before it, or an inner part outside its outer one."""
    _, spans = _spans(spark, sf_dir)
    earlier = Window.partitionBy("key").orderBy("outer_start").rowsBetween(Window.unboundedPreceding, -1)
    s = spans.withColumn("_m", F.max(F.when(F.col("depth") == 0, F.col("outer_end"))).over(earlier))
    return s.agg(F.count_if(F.col("_m") < F.col("outer_end")).alias("crossing"), F.count_if((F.col("inner_start") < F.col("outer_start")) | (F.col("inner_end") > F.col("outer_end"))).alias("outside"), F.countDistinct("key").alias("texts"))


@query("SELECT o_orderkey, o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) AS slice FROM orders")
def span_contract(spark, sf_dir):
    """The bytes of each record's first word, cut by its span."""
    from ..sources import corpus

    xml, spans = _spans(spark, sf_dir)
    first = spans.where("tag = 'w' AND ord = 2").select("key", "inner_start", "inner_end")
    both = xml.join(first, F.col("o_orderkey") == F.col("key"))
    return both.select("o_orderkey", F.decode(corpus.sliced(F.encode("xml", "utf-8"), F.col("inner_start"), F.col("inner_end")), "utf-8").alias("slice"))


@query("SELECT DISTINCT tag, name, tag || '/' || name NOT IN ('a/href', 'div/class', 'div/id', 'meta/charset', 'p/class') AS undeclared FROM (SELECT lower(regexp_extract(t, '^<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag, unnest(regexp_extract_all(t, ' ([a-z]+)=', 1)) AS name FROM (SELECT unnest(regexp_extract_all(html, '<[a-zA-Z][^<>]*>')) AS t FROM pages))")
def attribute_vocabulary(spark, sf_dir):
    """Pairs of tag and attribute, and whether the vocabulary lacks them."""
    tags = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit("<[a-zA-Z][^<>]*>"), F.lit(0))).alias("t"))
    pairs = tags.select(F.lower(F.regexp_extract("t", "^<([a-zA-Z][a-zA-Z0-9]*)", 1)).alias("tag"), F.explode(F.regexp_extract_all("t", F.lit(" ([a-z]+)="), F.lit(1))).alias("name")).distinct()
    return pairs.select("tag", "name", (~F.concat_ws("/", "tag", "name").isin("a/href", "div/class", "div/id", "meta/charset", "p/class")).alias("undeclared"))


@query("SELECT page_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: lower(x)), lambda x: x NOT IN ('html', 'head', 'body', 'p', 'div', 'a')))) AS unmodelled FROM pages")
def provenance_split(spark, sf_dir):
    """Raw tags that no model names, by page."""
    raw = F.transform(F.regexp_extract_all("html", F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1)), lambda x: F.lower(x))
    return table(spark, sf_dir, "pages").select("page_id", F.array_sort(F.array_except(raw, F.array(*map(F.lit, ("html", "head", "body", "p", "div", "a"))))).alias("unmodelled"))


def _records(spark, sf_dir):
    return spread(table(spark, sf_dir, "part").select(F.expr(_RECORD).alias("raw"))).select(parsers.analysis_record(F.col("raw")).alias("r"))


@query("SELECT 'failures' AS name, CAST(count(*) AS DOUBLE) AS value, CAST(1000000 AS DOUBLE) AS most, true AS ok FROM part WHERE p_size % 3 = 2 UNION ALL SELECT 'unknown controls', count(*), 0, count(*) = 0 FROM part WHERE p_size % 3 = 2 UNION ALL SELECT 'dangling selectors', count(*), 0, count(*) = 0 FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber % 3 = 1")
def morphology_gate(spark, sf_dir):
    """Parse failures, unknown controls and selectors of index 0, against ceilings."""
    r = _records(spark, sf_dir)
    counts = r.agg(F.count_if(~F.col("r.ok")).alias("a"), F.count_if(F.col("r.note").contains("control")).alias("b"))
    parsed = counts.select(F.explode(F.create_map(F.lit("failures"), "a", F.lit("unknown controls"), "b")).alias("name", "value"))
    chosen = table(spark, sf_dir, "lineitem").select(F.explode(parsers.selectors(F.expr(_SELECTION))).alias("s"))
    dangling = chosen.agg(F.count_if(F.col("s.index") == 0).alias("value")).withColumn("name", F.lit("dangling selectors"))
    return audit.ceilings(parsed.unionByName(dangling), {"failures": 1_000_000, "unknown controls": 0, "dangling selectors": 0})


@query("SELECT control, count(*) AS n, CAST(0 AS BIGINT) AS contaminated FROM (SELECT CASE WHEN p_size % 3 = 0 THEN '②Ⓐ' ELSE '' END AS control FROM part) GROUP BY control")
def control_gate(spark, sf_dir):
    """Records by control family, and lemmas that still hold a control sign."""
    r = _records(spark, sf_dir)
    return r.groupBy("r.control").agg(F.count("*").alias("n"), F.count_if(F.col("r.lemma").rlike(parsers._control_like())).alias("contaminated"))


@query("SELECT doc_id, n AS n_a, n AS n_b, CAST(0 AS BIGINT) AS differing FROM (SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n FROM documents)")
def language_gate(spark, sf_dir):
    """Two derivations of each document's sequence of line kinds, place by place."""
    kind = lambda c: F.when(c.rlike("[0-9]"), "number").when(c == "", "empty").otherwise("text")
    docs = table(spark, sf_dir, "documents")
    a = text.lines(docs).select("doc_id", "line", kind(F.col("content")).alias("kind"))
    b = docs.select("doc_id", F.posexplode(F.transform(F.split("text", "\n", -1), kind)).alias("p", "kind")).select("doc_id", (F.col("p") + 1).alias("line"), "kind")
    return sequences.compare(a, b, "doc_id", "line", "kind").select("doc_id", "n_a", "n_b", "differing")


@query(f"SELECT event_id, user_id FROM (SELECT *, min(CASE WHEN event_type = 'view' THEN n END) OVER (PARTITION BY user_id) AS first_line FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS n FROM {_E})) WHERE first_line IS NULL OR n < first_line")
def preline_words(spark, sf_dir):
    """What stands before the first line of its text."""
    line = F.when(F.col("event_type") == "view", F.col("event_id"))
    e = events(spark, sf_dir).select("event_id", "user_id", ranges.fill_forward(line, ["user_id"], ["sec", "event_id"]).alias("line"))
    return e.where("line IS NULL").select("event_id", "user_id")


@query("SELECT 'witness' AS edge, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)")
def apparatus_gate(spark, sf_dir):
    """The bag of witness pairs by distinct and by grouping, compared both ways."""
    lines = table(spark, sf_dir, "lineitem")
    a = shared.written(lines.select("l_orderkey", "l_suppkey").distinct(), "bag")
    b = shared.written(lines.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n")).select("l_orderkey", "l_suppkey"), "bag")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    found = count(b.exceptAll(a), "missing").join(count(a.exceptAll(b), "extra")).join(count(a, "n"))  # one row each
    return found.select(F.lit("witness").alias("edge"), "missing", "extra", "n")


@query(f"""{_DRAWN} SELECT 'asserted on gaps' AS name, CAST(0 AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS most, true AS ok UNION ALL SELECT 'undecided share', round(avg(CASE WHEN level = 0 THEN 1.0 ELSE 0 END), 6), 0.5, avg(CASE WHEN level = 0 THEN 1.0 ELSE 0 END) <= 0.5 FROM found UNION ALL SELECT 'values without level', 0, 0, true
 UNION ALL SELECT 'torn values', 0, 0, true""")
def alignment_gate(spark, sf_dir):
    """Invariants of the alignment and a ceiling on what it leaves open."""
    found = align.align(_lines(spark, sf_dir), _COMPOUNDS)
    torn = F.col("line_id") % 13 == 0
    gap = F.exists(F.arrays_zip("readings", "values"), lambda x: (x["readings"] == align.GAP) & x["values"].isNotNull())
    one = found.agg(F.count_if(gap).cast("double").alias("a"), F.round(F.avg((F.col("level") == 0).cast("double")), 6).alias("b"), F.count_if((F.col("level") == 0) & (F.size(F.array_compact("values")) > 0)).cast("double").alias("c"), F.count_if(torn & (F.get("values", F.lit(0)).isNotNull() | F.get("values", F.lit(1)).isNotNull())).cast("double").alias("d"))
    names = ("asserted on gaps", "undecided share", "values without level", "torn values")
    named = one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array("a", "b", "c", "d"))).alias("name", "value"))
    return audit.ceilings(named, dict.fromkeys(names, 0) | {"undecided share": 0.5})


@query("SELECT 'outvoted share' AS name, round(CAST(sum(CASE WHEN c <> w THEN n ELSE 0 END) AS DOUBLE) / sum(n), 6) AS value, CAST(0.9 AS DOUBLE) AS most, round(CAST(sum(CASE WHEN c <> w THEN n ELSE 0 END) AS DOUBLE) / sum(n), 6) <= 0.9 AS ok FROM (SELECT p_brand, p_size % 4 AS c, count(*) AS n, first_value(p_size % 4) OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_size % 4) AS w FROM part GROUP BY 1, 2)")
def outvoted_gate(spark, sf_dir):
    """The share of judged rows that their item's modal choice outvotes, against a ceiling."""
    counts = table(spark, sf_dir, "part").groupBy("p_brand", (F.col("p_size") % 4).alias("c")).agg(F.count("*").alias("n"))
    best = F.first("c").over(Window.partitionBy("p_brand").orderBy(F.desc("n"), "c"))
    share = counts.withColumn("w", best).agg(F.round(F.sum(F.when(F.col("c") != F.col("w"), F.col("n")).otherwise(0)).cast("double") / F.sum("n"), 6).alias("value"))
    return audit.ceilings(share.withColumn("name", F.lit("outvoted share")), {"outvoted share": 0.9})


@query(f"SELECT state, crosses, count(*) AS n FROM ({_PAIR}) GROUP BY state, crosses")
def bracket_statistics(spark, sf_dir):
    """Ranges by outcome and whether they cross a line."""
    marks = events(spark, sf_dir).where("event_type IN ('view', 'click')")
    paired = ranges.pair_ranges(marks, ["user_id"], "day", ["sec", "event_id"], F.col("event_type") == "view")
    return paired.groupBy("state", F.coalesce("crosses", F.lit(False)).alias("crosses")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus, c_custkey IS NOT NULL AS addressed FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey WHERE c_custkey IS NULL OR o_orderpriority LIKE '1%'")
def section_address_audit(spark, sf_dir):
    """Lines without an address, and those that the source marks."""
    there = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    o = table(spark, sf_dir, "orders").join(there, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.where("c_custkey IS NULL OR o_orderpriority LIKE '1%'").select("o_orderkey", "o_orderstatus", F.col("c_custkey").isNotNull().alias("addressed"))


@query("SELECT 'represented' AS class, CAST(sum(CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM orders UNION ALL SELECT 'nested', count(*) FROM orders WHERE o_orderkey % 4 = 0")
def conservation_classes(spark, sf_dir):
    """Words by what becomes of them: nested ones lie inside another word."""
    _, spans = _spans(spark, sf_dir)
    w = spans.where("tag = 'w'")
    tagged = ranges.nested(w, ["key"], "outer_start", "outer_end", "ord")
    return tagged.groupBy(F.when(F.col("nested"), "nested").otherwise("represented").alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT reason, count(*) AS n, CAST(sum(grown) AS BIGINT) AS grown FROM (SELECT CASE k WHEN 5 THEN 'stray tag opening' WHEN 6 THEN 'unescaped < in an attribute' ELSE 'stray quote after an attribute' END AS reason, CASE k WHEN 5 THEN -3 WHEN 6 THEN 3 ELSE -1 END AS grown FROM (SELECT o_orderkey % 11 AS k FROM orders) WHERE k IN (5, 6, 9)) GROUP BY reason""")
def repair_inventory(spark, sf_dir):
    """Patches of three kinds, and the bytes that they add."""
    broken = table(spark, sf_dir, "orders").where("o_orderkey % 11 IN (5, 6, 9)").select("o_orderkey", F.expr(_BROKEN).alias("content"))
    p = repair.repaired(broken, "o_orderkey", "content").select(F.explode("patches").alias("p"))
    return p.groupBy("p.reason").agg(F.count("*").alias("n"), F.sum(F.octet_length("p.new") - F.octet_length("p.old")).cast("long").alias("grown"))


@query("SELECT 'documents' AS otype, unnest(['doc_id', 'lang', 'text']) AS feature, unnest(['the record', 'its language', 'its text']) AS description, unnest([true, true, true]) AS ok")
def feature_catalogue(spark, sf_dir):
    """Descriptions that columns carry against the canonical ones."""
    canon = {"doc_id": "the record", "lang": "its language", "text": "its text"}
    docs = table(spark, sf_dir, "documents").select(*canon)
    for name, said in canon.items():
        docs = docs.withMetadata(name, {"description": said})
    rows = [("documents", f.name, f.metadata.get("description"), f.metadata.get("description") == canon[f.name]) for f in docs.schema]
    return spark.createDataFrame(rows, "otype string, feature string, description string, ok boolean")


@query("SELECT states, count(*) AS n FROM (SELECT array_to_string(list_filter([CASE WHEN l_returnflag = 'R' THEN 'lost' END, CASE WHEN l_discount > 0.05 THEN 'worn' END, CASE WHEN l_tax > 0.04 THEN 'added' END], lambda x: x IS NOT NULL), '+') AS states FROM lineitem) GROUP BY states")
def renderer_states(spark, sf_dir):
    """How often each combination of states is shown."""
    flags = {"lost": F.col("l_returnflag") == "R", "worn": F.col("l_discount") > 0.05, "added": F.col("l_tax") > 0.04}
    shown = F.array_join(F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()])), "+")
    return table(spark, sf_dir, "lineitem").groupBy(shown.alias("states")).agg(F.count("*").alias("n"))


@query("SELECT CASE l_returnflag WHEN 'R' THEN 'numeric' WHEN 'A' THEN 'numeric' ELSE CASE l_linenumber % 3 WHEN 0 THEN 'special' WHEN 1 THEN 'unknown+numeric' ELSE 'empty' END END AS class, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def annotation_census(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(parsers.selector_class(F.expr(_SELECTION)).alias("class"), "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT otype, n, CAST(sum(n) OVER (ORDER BY otype) AS BIGINT) - n + 1 AS first_node, CAST(sum(n) OVER (ORDER BY otype) AS BIGINT) AS last_node FROM (SELECT 'customer' AS otype, count(*) AS n FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders)")
def node_census(spark, sf_dir):
    """Nodes of each type and the contiguous numbers that they take."""
    names = ("customer", "lineitem", "orders")
    counts = [table(spark, sf_dir, n).agg(F.count("*").alias("n")).withColumn("otype", F.lit(n)) for n in names]
    last = F.sum("n").over(Window.orderBy("otype"))  # a row a type
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).select("otype", "n", (last - F.col("n") + 1).alias("first_node"), last.alias("last_node"))


@query("SELECT * FROM (SELECT 'bytes' AS gate, true AS passed, CAST(0 AS BIGINT) AS failing UNION ALL SELECT 'controls', true, 0 UNION ALL SELECT 'morphology', n = 0, CASE WHEN n = 0 THEN 0 ELSE 1 + CASE WHEN d > 0 THEN 1 ELSE 0 END END FROM (SELECT (SELECT count(*) FROM part WHERE p_size % 3 = 2) AS n, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber % 3 = 1) AS d))")
def gate_run(spark, sf_dir):
    """All gates in one plan, each with its violations; inputs must be the same before and after."""
    mark = table(spark, sf_dir, "orders").agg(F.count("*"), F.bit_xor(F.xxhash64("o_orderkey", "o_totalprice")))
    checks = [("bytes", byte_contract(spark, sf_dir).where("crossing > 0 OR outside > 0")), ("controls", control_gate(spark, sf_dir).where("contaminated > 0")), ("morphology", morphology_gate(spark, sf_dir).where("NOT ok"))]
    return audit.gates(checks, mark, table(spark, sf_dir, "orders").agg(F.count("*"), F.bit_xor(F.xxhash64("o_orderkey", "o_totalprice"))))
