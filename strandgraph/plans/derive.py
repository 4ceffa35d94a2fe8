"""Derivations: hierarchy, language, alignment, apparatus, sequences, slot templates and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import align, hierarchy, ordered, ranges, sequences, stats, template
from ..sources.tables import table
from ..streaming import events as streams
from .intervals import _E, _SESSIONS, events, sessions
from .registry import query


@query("""WITH e AS (SELECT o_custkey, o_orderkey, o_orderstatus AS label, o_orderpriority LIKE '1%' AS ruling, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS colon FROM orders),
c AS (SELECT *, CASE WHEN lag(label) OVER w IS NOT DISTINCT FROM label AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c, coalesce(lag(ruling) OVER w, false) AS after FROM e WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
p AS (SELECT *, CAST(sum(c) OVER w AS BIGINT) AS column_no, CAST(sum(CASE WHEN c = 1 OR after THEN 1 ELSE 0 END) OVER w AS BIGINT) AS paragraph_no, CAST(sum(CASE WHEN colon IS NOT NULL THEN 1 ELSE 0 END) OVER w AS BIGINT) AS k, max(CASE WHEN c = 1 THEN o_orderkey END) OVER w AS began, max(CASE WHEN colon IS NOT NULL THEN o_orderkey END) OVER w AS mark FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, o_orderkey, column_no, paragraph_no, CASE WHEN mark >= began THEN k END AS colon_no FROM p""")
def hierarchy_build(spark, sf_dir):
    """Columns where the status changes, paragraphs after rulings, colons that end with their column."""
    lines = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("label"), F.when(F.col("o_orderpriority").startswith("1"), "single").alias("ruling"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("colon"))
    return hierarchy.containers(lines, ["o_custkey"], ["o_orderkey"], "label", "ruling", "colon").select("o_custkey", "o_orderkey", "column_no", "paragraph_no", "colon_no")


@query("""SELECT o_custkey, column_no, min(o_orderkey) AS first_slot, max(o_orderkey) AS last_slot, count(*) AS n FROM (SELECT *, CAST(sum(c) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS column_no FROM
 (SELECT *, CASE WHEN lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = o_orderstatus THEN 0 ELSE 1 END AS c FROM orders)) GROUP BY o_custkey, column_no""")
def column_extents(spark, sf_dir):
    by, order = ["o_custkey"], ["o_orderkey"]
    lines = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus").withColumn("_c", hierarchy.differs(F.col("o_orderstatus"), by, order))
    return hierarchy.extents(lines.withColumn("column_no", hierarchy.numbered(F.col("_c"), by, order)), ["o_custkey", "column_no"], "o_orderkey")


@query(f"""WITH e AS (SELECT event_id, user_id, sec, CASE WHEN event_type = 'click' THEN 'clk' WHEN event_type = 'view' AND event_id % 2 = 0 THEN '' END AS own, event_type IN ('signup', 'purchase') AS mark, CASE WHEN event_type = 'signup' THEN 'sgn' END AS col, CASE WHEN event_id % 3 = 0 THEN 'XXXlang' WHEN event_id % 3 = 1 THEN 'lin' END AS line FROM {_E}),
m AS (SELECT *, max(CASE WHEN mark THEN n END) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING) AS at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS n FROM e))
SELECT m.event_id, coalesce(nullif(m.own, ''), k.col, nullif(m.line, 'XXXlang'), 'txt') AS lang FROM m LEFT JOIN m k ON k.user_id = m.user_id AND k.n = m.at""")
def language_precedence(spark, sf_dir):
    """Word over active colon over line over text; a colon mark without a language ends the one before."""
    kind, n = F.col("event_type"), F.col("event_id")
    own = F.when(kind == "click", "clk").when((kind == "view") & (n % 2 == 0), "")
    line = F.when(n % 3 == 0, "XXXlang").when(n % 3 == 1, "lin")
    colon = hierarchy.active(kind.isin("signup", "purchase"), F.when(kind == "signup", "sgn"), ["user_id"], ["sec", "event_id"])
    return events(spark, sf_dir).select("event_id", hierarchy.language(own, colon, line, F.lit("txt")).alias("lang"))


@query("SELECT c_custkey, 'empty' AS type, 1 AS anchor FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderstatus = 'F')")
def empty_anchors(spark, sf_dir):
    """An artificial slot for each container that holds none."""
    return hierarchy.anchors(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_orderpriority LIKE '1%' AND o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


_COMPOUNDS = {"MEŠ": "𒈨𒌍", "ZI.GA": "𒍣𒂵"}
#: Lines drawn from the lineitems of an order: each is a syllable, a compound, a numeral or a trace, and some leave a
#: surplus placeholder behind.  Every thirteenth order begins with a compound that is torn.
_KIND = "CASE WHEN l_partkey % 11 = 0 THEN 'trace' WHEN l_partkey % 7 = 0 THEN 'compound' WHEN l_partkey % 7 = 1 THEN 'numeral' ELSE 'sign' END"
_N = "element_at(array(2, 3, 4, 11, 12, 13, 20, 21, 22, 30, 31), CAST(l_partkey % 11 AS INT) + 1)"
_DRAWN = f"""WITH n AS (SELECT unnest([2, 3, 4, 11, 12, 13, 20, 21, 22, 30, 31]) AS value, unnest(range(11)) AS k),
t AS (SELECT l_orderkey AS line_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_tax) + CASE WHEN l_orderkey % 13 = 0 THEN 4 ELSE 0 END AS pos, {_KIND} AS kind, l_tax > 0.06 AS surplus, l_partkey, l_suppkey FROM lineitem),
drawn AS (SELECT line_id, pos, kind, surplus, CASE kind WHEN 'trace' THEN 'x' WHEN 'compound' THEN CASE WHEN l_suppkey % 2 = 0 THEN 'MEŠ' ELSE 'ZI.GA' END WHEN 'numeral' THEN CAST(value AS VARCHAR) ELSE 's' || CAST(l_partkey % 20 AS VARCHAR) END AS reading,
  CASE kind WHEN 'trace' THEN '▒' WHEN 'compound' THEN CASE WHEN l_suppkey % 2 = 0 THEN '𒈨𒌍' ELSE '𒍣𒂵' END WHEN 'numeral' THEN repeat('𒌋', value // 10) || repeat('𒁹', value % 10) ELSE chr(CAST(73728 + l_partkey % 20 AS INTEGER)) END AS glyph FROM t JOIN n ON k = l_partkey % 11
 UNION ALL SELECT o, p, kind, p = 4, reading, glyph FROM (SELECT DISTINCT l_orderkey AS o FROM lineitem WHERE l_orderkey % 13 = 0), (SELECT unnest(range(1, 5)) AS p, unnest(['torn', 'torn', 'trace', 'compound']) AS kind, unnest(['MEŠ', 'b', 'x', 'ZI.GA']) AS reading, unnest(['𒈨', '𒌍', '▒', '𒍣𒂵']) AS glyph)),
lines AS (SELECT line_id, bool_or(kind IN ('torn', 'compound')) AS c, bool_or(kind = 'numeral') AS m, bool_or(surplus) AS s FROM drawn GROUP BY line_id),
found AS (SELECT line_id, c, m, s, CASE WHEN s THEN CASE WHEN m THEN 0 WHEN c THEN 3 ELSE 2 END WHEN m THEN 4 WHEN c THEN 3 ELSE 1 END AS level FROM lines)"""


def _lines(spark, sf_dir):
    kind, even, n = F.expr(_KIND), F.col("l_suppkey") % 2 == 0, F.expr(_N)
    glyphs = lambda *xs: F.array(*map(F.lit, xs))
    tokens = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("line_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_tax").alias("at"), (F.col("l_tax") > 0.06).alias("surplus"),
        F.when(kind == "trace", "x").when(kind == "compound", F.when(even, "MEŠ").otherwise("ZI.GA")).when(kind == "numeral", n.cast("string")).otherwise(F.concat(F.lit("s"), (F.col("l_partkey") % 20).cast("string"))).alias("reading"),
        F.when(kind == "trace", glyphs("▒")).when(kind == "compound", F.when(even, glyphs("𒈨", "𒌍")).otherwise(glyphs("𒍣", "𒂵"))).when(kind == "numeral", F.concat(F.array_repeat(F.lit("𒌋"), F.floor(n / 10).cast("int")), F.array_repeat(F.lit("𒁹"), (n % 10).cast("int"))))
        .otherwise(F.array(F.element_at(glyphs(*[chr(0x12000 + i) for i in range(20)]), (F.col("l_partkey") % 20 + 1).cast("int")))).alias("glyph"),
    )
    whole = tokens.groupBy("line_id").agg(F.array_sort(F.collect_list(F.struct("at", "reading", "glyph", "surplus"))).alias("t"))  # an order's lineitems
    torn = F.col("line_id") % 13 == 0
    readings, surplus = F.transform("t", lambda x: x["reading"]), F.transform("t", lambda x: F.when(x["surplus"], F.concat(x["glyph"], glyphs("▒"))).otherwise(x["glyph"]))
    return whole.select(
        "line_id", F.when(torn, F.concat(glyphs("MEŠ", "b", "x", "ZI.GA"), readings)).otherwise(readings).alias("readings"),
        F.when(torn, F.concat(glyphs("𒈨", "𒌍", "▒", "𒍣", "𒂵", "▒"), F.flatten(surplus))).otherwise(F.flatten(surplus)).alias("glyphs"), (torn | F.exists("t", lambda x: x["surplus"])).alias("damaged"),
    )


_VALUE = "CASE WHEN level > 0 AND kind <> 'torn' THEN glyph END"


@query(f"""{_DRAWN} SELECT line_id, level, coalesce(string_agg({_VALUE}, ' ' ORDER BY pos), '') AS signs, CASE WHEN level = 0 THEN '' WHEN level = 1 THEN 'zip' WHEN level = 2 THEN 'damage' WHEN level = 4 THEN 'numeral' WHEN s THEN 'damage+compound' ELSE 'compound' END AS method
 FROM drawn JOIN found USING (line_id) GROUP BY line_id, level, s""")
def sequence_alignment(spark, sf_dir):
    """Drawn lines: all levels, traces, surplus placeholders, and torn compounds whose values are withheld."""
    found = align.align(_lines(spark, sf_dir), _COMPOUNDS)
    return found.select("line_id", "level", F.array_join("values", " ").alias("signs"), F.array_join("methods", "+").alias("method"))


@query(f"""{_DRAWN} SELECT line_id, pos, {_VALUE} AS cu_sign, CAST(length({_VALUE}) AS INTEGER) AS cu_nsigns FROM drawn JOIN found USING (line_id)""")
def alignment_projection(spark, sf_dir):
    return align.project(align.align(_lines(spark, sf_dir), _COMPOUNDS)).select("line_id", "pos", "cu_sign", "cu_nsigns")


@query(f"""{_DRAWN} SELECT level, count(*) AS lines, CAST(sum(n) AS BIGINT) AS signs, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share FROM (SELECT line_id, level, count({_VALUE}) AS n FROM drawn JOIN found USING (line_id) GROUP BY 1, 2) GROUP BY level""")
def alignment_coverage(spark, sf_dir):
    """Lines and decided signs by level, and each level's share."""
    found = align.align(_lines(spark, sf_dir), _COMPOUNDS)
    each = found.groupBy("level").agg(F.count("*").alias("lines"), F.sum(F.size(F.array_compact("values"))).alias("signs"))
    total = F.sum("lines").over(Window.partitionBy())  # a row a level
    return each.select("level", "lines", "signs", F.round(100.0 * F.col("lines") / total, 4).alias("share"))


@query(f"""{_DRAWN} SELECT reading, glyph, count(*) AS top_obs, count(*) AS total_obs, CAST(1 AS DOUBLE) AS confidence FROM drawn JOIN found USING (line_id) WHERE level = 1 GROUP BY reading, glyph HAVING count(*) >= 5""")
def learned_signs(spark, sf_dir):
    return align.learn_pairs(_lines(spark, sf_dir))


@query(f"""{_DRAWN}, single AS (SELECT reading FROM drawn JOIN found USING (line_id) WHERE level = 1 GROUP BY reading HAVING count(*) >= 5),
p AS (SELECT d.*, kind IN ('compound', 'numeral') AS multi, kind NOT IN ('compound', 'numeral') AND reading NOT IN (SELECT reading FROM single) AS unknown FROM drawn d JOIN found USING (line_id) WHERE NOT s AND level > 1),
w AS (SELECT *, sum(CASE WHEN unknown OR multi AND following THEN 1 ELSE 0 END) OVER (PARTITION BY line_id ORDER BY pos) AS stops FROM (SELECT *, coalesce(lead(multi OR unknown) OVER (PARTITION BY line_id ORDER BY pos), false) AS following FROM p))
SELECT reading, glyph, count(*) AS top_obs, count(*) AS total_obs, CAST(1 AS DOUBLE) AS confidence FROM w WHERE multi AND stops = 0 GROUP BY reading, glyph HAVING count(*) >= 5""")
def learned_compounds(spark, sf_dir):
    """Compounds and numerals between readings that the map of single signs anchors; two side by side end a line's search."""
    lines = _lines(spark, sf_dir)
    return align.learn_compounds(lines.where("NOT damaged"), align.learn_pairs(lines))


@query("""WITH b AS (SELECT *, sum(CASE WHEN kind = 'barrier' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS blk FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 0 THEN 'barrier' WHEN o_orderstatus = 'O' THEN 'separator' ELSE 'entry' END AS kind FROM orders)),
s AS (SELECT *, last_value(CASE WHEN kind = 'entry' THEN o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey, blk ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS "left", first_value(CASE WHEN kind = 'entry' THEN o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey, blk ORDER BY o_orderkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS "right" FROM b)
SELECT o_custkey, o_orderkey, "left", "right", "left" IS NOT NULL AND "right" IS NOT NULL AS resolved FROM s WHERE kind = 'separator'""")
def apparatus_statements(spark, sf_dir):
    status, n = F.col("o_orderstatus"), F.col("o_orderkey")
    kind = F.when((status == "F") & (n % 4 == 0), "barrier").when(status == "O", "separator").otherwise("entry")
    tokens = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", kind.alias("kind"), n.alias("value"))
    return hierarchy.apparatus(tokens, ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", "left", "right", "resolved")


@query("SELECT l_orderkey, p_brand AS siglum, count(*) AS n, count(DISTINCT p_type) > 1 AS conflict FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_sigla(spark, sf_dir):
    """Sigla that a block gives more than once, and whether they stand for different things."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    each = rows.groupBy("l_orderkey", F.col("p_brand").alias("siglum")).agg(F.count("*").alias("n"), (F.min("p_type") != F.max("p_type")).alias("conflict"))
    return each.where("n > 1")


@query("""WITH w AS (SELECT o_orderkey, unnest(string_split('€' || CAST(o_orderkey % 7 AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN '+' || CAST(o_orderkey % 5 AS VARCHAR) ELSE '' END, '+')) AS s FROM orders), f AS (SELECT l_orderkey, '€' || CAST(l_partkey % 7 AS VARCHAR) AS s, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT DISTINCT o_orderkey, f.s AS siglum, CASE WHEN n = 1 THEN 'unique' ELSE 'ambiguous' END AS resolution FROM (SELECT o_orderkey, CASE WHEN s LIKE '€%' THEN s ELSE '€' || s END AS s FROM w) w JOIN f ON f.l_orderkey = w.o_orderkey AND f.s = w.s""")
def composite_witnesses(spark, sf_dir):
    """Composite sigla taken apart and resolved inside their own block."""
    from ..functions import parsers

    key = F.col("o_orderkey")
    frag = F.concat(F.lit("{€"), (key % 7).cast("string"), F.when(key % 3 == 0, F.concat(F.lit("+"), (key % 5).cast("string"))).otherwise(""), F.lit("} 1"))
    lines = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(parsers.line_reference(frag)["frags"]).alias("siglum")).distinct()
    named = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.concat(F.lit("€"), (F.col("l_partkey") % 7).cast("string")).alias("s")).agg(F.count("*").alias("n"))
    both = lines.join(named, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("siglum") == F.col("s")))
    return both.select("o_orderkey", "siglum", F.when(F.col("n") == 1, "unique").otherwise("ambiguous").alias("resolution"))


@query("SELECT c_custkey, coalesce(min(o_orderkey), -c_custkey) AS lo, coalesce(max(o_orderkey), -c_custkey) AS hi, min(o_orderkey) IS NULL AS anchored FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def fragment_extents(spark, sf_dir):
    held = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("lo"), F.col("o_orderkey").alias("hi"))
    return hierarchy.fragment_extents(table(spark, sf_dir, "customer").withColumn("_a", -F.col("c_custkey")), held, "c_custkey", "_a")


_DAMAGED = f"""(SELECT event_id AS node, user_id AS doc, sec AS lo, sec + CAST(event_id % 40 AS BIGINT) * 600 AS hi FROM {_E} WHERE event_type = 'error')"""


def _slot_types(spark, sf_dir):
    e = events(spark, sf_dir)
    word = sessions(spark, sf_dir).select((F.col("user_id") * 100000 + F.col("session")).alias("node"), F.col("user_id").alias("doc"), "lo", "hi", "n", (F.col("lo") < F.col("hi")).alias("extent"))
    sign = e.where("event_type <> 'error'").select(F.col("event_id").alias("node"), F.col("user_id").alias("doc"), F.col("sec").alias("lo"), F.col("sec").alias("hi"), F.col("event_type").alias("kind"))
    cluster = e.where("event_type = 'error'").select(F.col("event_id").alias("node"), F.col("user_id").alias("doc"), F.col("sec").alias("lo"), (F.col("sec") + (F.col("event_id") % 40) * 600).alias("hi"))
    return {"word": word, "sign": sign, "cluster": cluster}


@query(f"SELECT s.user_id * 100000 + s.session AS n0, e.event_id AS n1 FROM {_SESSIONS} s JOIN {_E} e ON e.user_id = s.user_id AND e.sec BETWEEN s.lo AND s.hi WHERE s.n > 2 AND s.lo < s.hi AND e.event_type = 'purchase'")
def slot_template(spark, sf_dir):
    return template.search_slots("word n>2\n  sign kind='purchase'", _slot_types(spark, sf_dir))


@query(f"SELECT s.user_id * 100000 + s.session AS n0 FROM {_SESSIONS} s WHERE s.lo < s.hi AND NOT EXISTS (SELECT 1 FROM {_DAMAGED} d WHERE d.doc = s.user_id AND d.lo >= s.lo AND d.hi <= s.hi)")
def slot_template_contains(spark, sf_dir):
    return template.search_slots("word\n/without/\n  cluster\n/-/", _slot_types(spark, sf_dir))


@query(f"SELECT s.user_id * 100000 + s.session AS n0 FROM {_SESSIONS} s WHERE s.lo < s.hi AND NOT EXISTS (SELECT 1 FROM {_DAMAGED} d WHERE d.doc = s.user_id AND d.lo <= s.hi AND d.hi >= s.lo)")
def slot_template_overlaps(spark, sf_dir):
    return template.search_slots("word\n/without/\n  cluster\n/-/", _slot_types(spark, sf_dir), mode="overlaps")


@query(f"SELECT s.user_id * 100000 + s.session AS n0 FROM {_SESSIONS} s WHERE s.lo < s.hi AND NOT EXISTS (SELECT 1 FROM {_DAMAGED} d WHERE d.doc = s.user_id AND d.lo <= s.hi AND d.hi >= s.lo AND d.hi > d.lo)")
def slot_template_flagged(spark, sf_dir):
    return template.search_slots("word\n/without/\n  cluster\n/-/", _slot_types(spark, sf_dir), mode="flagged")


@query(f"SELECT s.user_id * 100000 + s.session AS n0, e.event_id AS n1 FROM {_SESSIONS} s JOIN {_E} e ON e.user_id = s.user_id WHERE s.n > 6 AND s.lo < s.hi AND e.event_type = 'signup'")
def slot_template_siblings(spark, sf_dir):
    return template.search_slots("word n>6\nsign kind=signup", _slot_types(spark, sf_dir))


@query(f"SELECT e.event_id, s.session FROM {_E} e JOIN {_SESSIONS} s ON s.user_id = e.user_id AND e.sec + 3000 BETWEEN s.lo AND s.hi")
def point_in_interval(spark, sf_dir):
    """The session that holds a point in time, by the latest start and no join: sessions of a user don't overlap."""
    points = events(spark, sf_dir).select("user_id", (F.col("sec") + 3000).alias("at"), F.lit(1).alias("side"), "event_id", F.lit(None).cast("struct<session:bigint,hi:bigint>").alias("s"))
    starts = sessions(spark, sf_dir).select("user_id", F.col("lo").alias("at"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("event_id"), F.struct(F.col("session").cast("long").alias("session"), F.col("hi").cast("long").alias("hi")).alias("s"))
    held = ranges.fill_forward(F.col("s"), ["user_id"], ["at", "side"])
    return starts.unionByName(points).withColumn("h", held).where("side = 1 AND at <= h.hi").select("event_id", "h.session")


@query("""WITH x AS (SELECT doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, source FROM documents), e AS (SELECT source, n, doc_id FROM x) SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY source) AS label FROM e QUALIFY count(*) OVER (PARTITION BY source) > 1""")
def chained_components(spark, sf_dir):
    """Components of chains: each document is linked with the next one of its source only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    edges = ordered.following(docs, ["source"], ["doc_id"], ["doc_id"]).select(F.col("doc_id").alias("a"), F.col("next.doc_id").alias("b")).where("b IS NOT NULL")
    return stats.min_label_components(edges)


@query("""WITH a AS (SELECT conv_id, turn, role FROM conversations), b AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'x' ELSE role END AS role FROM conversations WHERE NOT (conv_id % 4 = 0 AND turn > 1)),
a1 AS (SELECT conv_id, turn AS p, role FROM a), j AS (SELECT coalesce(a1.conv_id, b.conv_id) AS conv_id, coalesce(a1.p, b.turn) AS p, a1.conv_id IS NOT NULL AS ia, b.conv_id IS NOT NULL AS ib, a1.role AS ra, b.role AS rb FROM (SELECT * FROM a1) a1 FULL JOIN b ON a1.conv_id = b.conv_id AND a1.p = b.turn),
d AS (SELECT *, NOT (ia AND ib AND ra IS NOT DISTINCT FROM rb) AS d FROM j) SELECT conv_id, CAST(sum(CASE WHEN ia THEN 1 ELSE 0 END) AS BIGINT) AS n_a, CAST(sum(CASE WHEN ib THEN 1 ELSE 0 END) AS BIGINT) AS n_b, CAST(sum(CASE WHEN d THEN 1 ELSE 0 END) AS BIGINT) AS differing, coalesce(list_sort(list(p) FILTER (WHERE d))[1:2], []) AS first_at FROM d GROUP BY conv_id""")
def sequence_compare(spark, sf_dir):
    """Two derivations of each conversation's roles, place by place; the changes are made by place."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    other = rows.where("NOT (conv_id % 4 = 0 AND turn > 1)").withColumn("role", F.when(F.col("turn") % 3 == 0, "x").otherwise(F.col("role")))
    return sequences.compare(rows, other, "conv_id", "turn", "role", 2)


@query()
def variant_diff(spark, sf_dir):
    """Word edits from the first message of a conversation and role to each later one."""
    rows = table(spark, sf_dir, "conversations").select(F.concat_ws("/", F.col("conv_id").cast("string"), "role").alias("group"), "turn", F.split("text", " ").alias("words"))
    return sequences.variants(rows, "group", "turn", "words")


@query()
def reuse_blocks(spark, sf_dir):
    """Runs of five words or more that a benchmark item shares with the documents that hold one of its shingles."""
    words = F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))
    items = table(spark, sf_dir, "benchmark").select("item_id", words.alias("a"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    from .texts import shingle_reuse

    pairs = shingle_reuse(spark, sf_dir).select("item_id", "doc_id")
    both = pairs.join(items, "item_id").join(docs, "doc_id").select("item_id", "doc_id", "a", words.alias("b"))
    return sequences.blocks(both, ["item_id", "doc_id"], "a", "b")


def _timed(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_run_tumbling(spark, sf_dir):
    return streams.ended(_timed(spark, sf_dir), streams.tumbling).where("window.start < '2900-01-01'").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT CAST(to_timestamp(s * 7200) AT TIME ZONE 'UTC' AS TIMESTAMP) AS start, count(*) AS n FROM (SELECT unnest(range(CAST(floor(epoch(ts) / 7200) AS BIGINT) - 2, CAST(floor(epoch(ts) / 7200) AS BIGINT) + 1)) AS s FROM events) GROUP BY s")
def stream_run_sliding(spark, sf_dir):
    return streams.ended(_timed(spark, sf_dir), streams.sliding).where("window.start < '2900-01-01'").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT user_id, event_type, CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS day FROM events GROUP BY 1, 2, 3")
def stream_run_dedup(spark, sf_dir):
    return streams.ended(_timed(spark, sf_dir), streams.first_of_day, None).select("user_id", "event_type", F.col("day").cast("date").cast("string").alias("day"))


@query("SELECT user_id, count(*) AS n FROM (SELECT user_id, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 21600 THEN 0 ELSE 1 END AS new FROM events) WHERE new = 1 GROUP BY user_id")
def stream_run_session(spark, sf_dir):
    """How many sessions each user has, from session windows of a stream."""
    found = streams.ended(_timed(spark, sf_dir), streams.session).where("session_window.start < '2900-01-01'")
    return found.groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS n, max(event_id) AS last FROM events GROUP BY user_id")
def stream_run_state(spark, sf_dir):
    """A user's running totals from state that the stream keeps; the largest is the last."""
    found = streams.ended(_timed(spark, sf_dir).select("event_id", "user_id", "ts"), streams.running, None)
    return found.groupBy("user_id").agg(F.max("n").alias("n"), F.max("last").alias("last"))
