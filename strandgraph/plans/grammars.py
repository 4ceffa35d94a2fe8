"""Queries that build source records from the tables' columns and read them with the grammars; the SQL knows the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsers
from ..operators import markup, repair
from ..sources import corpus
from ..sources.shared import written
from ..sources.tables import spread, table
from .registry import query

_K = "CAST(o_orderkey AS STRING)"
_PATH = f"""CASE o_orderkey % 10 WHEN 0 THEN '/CTH 1_XML/' || {_K} || '.xml' WHEN 1 THEN 'CTH 1_XML' || chr(92) || {_K} WHEN 2 THEN 'CTH 1_XML/../' || {_K} || '.xml' WHEN 3 THEN 'CTH 1_XML/a/'
 WHEN 4 THEN {_K} || '.xml' WHEN 5 THEN 'CTH 1_XML//' || {_K} || '.xml' WHEN 6 THEN 'CTH 1_XML/' || {_K} || '.txt' WHEN 7 THEN 'CTH 1_XML/.xml' WHEN 8 THEN 'CTHX/' || {_K} || '.xml'
 ELSE 'CTH ' || CAST(o_orderkey % 900 AS STRING) || '_XML_Proj' || CAST(o_orderkey % 7 AS STRING) || '/sub/' || {_K} || '.xml' END"""


@query("""SELECT o_orderkey, CASE WHEN k = 9 THEN CAST(o_orderkey % 900 AS VARCHAR) ELSE '' END AS cth, CASE WHEN k = 9 THEN 'Proj' || CAST(o_orderkey % 7 AS VARCHAR) ELSE '' END AS project,
 CASE k WHEN 9 THEN 'sub' WHEN 3 THEN 'a' ELSE '' END AS source_subdir, CASE WHEN k IN (2, 4, 5, 8, 9) THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS source_stem, k = 9 AS parse_ok,
 CASE k WHEN 0 THEN 'absolute_path' WHEN 1 THEN 'non_posix_separator' WHEN 2 THEN 'path_traversal' WHEN 3 THEN 'missing_filename' WHEN 4 THEN 'missing_top_directory' WHEN 5 THEN 'empty_path_component' WHEN 6 THEN 'not_xml'
 WHEN 7 THEN 'missing_filename' WHEN 8 THEN 'invalid_top_directory' ELSE '' END AS parse_error FROM (SELECT o_orderkey, o_orderkey % 10 AS k FROM orders)""")
def source_path_parse(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", parsers.source_path(F.expr(_PATH)).alias("p")).select("o_orderkey", "p.*")


_REF = """'{€' || CAST(l_linenumber AS STRING) || CASE WHEN l_linenumber % 3 = 0 THEN '+9' ELSE '' END || '} ' || CASE l_linestatus WHEN 'O' THEN 'Vs. ' ELSE 'lk. Rd. ' END
 || CASE l_returnflag WHEN 'R' THEN 'II ' WHEN 'A' THEN 'Kol. I ' ELSE '' END || CAST(l_partkey AS STRING) || CASE WHEN l_linenumber % 2 = 0 THEN '′' ELSE '' END || CASE WHEN l_linenumber % 5 = 0 THEN 'a/b' ELSE '' END"""


@query("""SELECT *, concat_ws(' ', frag, surface, nullif("column", '')) AS collabel, CAST(ln AS VARCHAR) || prime || tail AS lnno FROM (SELECT l_orderkey, l_linenumber, '€' || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_linenumber % 3 = 0 THEN '+9' ELSE '' END AS frag,
 CASE WHEN l_linenumber % 3 = 0 THEN ['€' || CAST(l_linenumber AS VARCHAR), '€9'] ELSE ['€' || CAST(l_linenumber AS VARCHAR)] END AS frags, CASE l_linestatus WHEN 'O' THEN 'Vs.' ELSE 'lk. Rd.' END AS surface,
 CASE l_returnflag WHEN 'R' THEN 'II' WHEN 'A' THEN 'Kol. I' ELSE '' END AS "column", CAST(l_partkey AS INTEGER) AS ln, CASE WHEN l_linenumber % 2 = 0 THEN '′' ELSE '' END AS prime, CASE WHEN l_linenumber % 5 = 0 THEN 'a/b' ELSE '' END AS tail FROM lineitem)""")
def line_reference_parse(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parsers.line_reference(F.expr(_REF)).alias("r")).select("l_orderkey", "l_linenumber", "r.*")


_RECORD = """CASE p_size % 3 WHEN 0 THEN '②Ⓐ ' WHEN 1 THEN '' ELSE '⊕⊖ ' END || lower(p_brand) || '- @ ' || p_type || ' @{ a → NOM.SG}{ b → ' || CAST(p_size AS STRING) || '}@'
 || CASE p_size % 4 WHEN 0 THEN 'I.' || CAST(p_size AS STRING) WHEN 1 THEN 'ADV, POSP' WHEN 2 THEN '' ELSE 'GEN.SG' END || '@' || CASE WHEN p_size % 5 = 0 THEN ' += ma@CNJctr@@ m' ELSE 'D' END"""


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN '' ELSE lower(p_brand) || '-' END AS lemma, p_type AS gloss, CASE WHEN p_size % 3 = 0 THEN '②Ⓐ' ELSE '' END AS control, p_size % 3 <> 2 AS ok, CASE WHEN p_size % 3 = 2 THEN 'unknown analysis-control prefix' ELSE '' END AS note,
 CAST(p_size AS VARCHAR) AS alt_b, CASE p_size % 4 WHEN 0 THEN 'stemclass' WHEN 1 THEN 'pos' WHEN 2 THEN 'empty' ELSE 'morph' END AS field4_kind, CASE WHEN p_size % 4 = 1 THEN 'ADV POSP' ELSE '' END AS pos,
 CASE WHEN p_size % 5 = 0 THEN '' ELSE 'D' END AS det, CASE WHEN p_size % 5 = 0 THEN 'ma' END AS clitic_lemma, CASE WHEN p_size % 5 = 0 THEN 'CNJctr' END AS clitic_morph, CASE WHEN p_size % 5 = 0 THEN 'm' END AS clitic_det, true AS normalised FROM part""")
def analysis_record_parse(spark, sf_dir):
    r = spread(table(spark, sf_dir, "part").select("p_partkey", F.expr(_RECORD).alias("raw"))).select("p_partkey", parsers.analysis_record(F.col("raw")).alias("r"))
    return r.select("p_partkey", "r.lemma", "r.gloss", "r.control", "r.ok", "r.note", F.element_at("r.alts", "b").alias("alt_b"), "r.field4_kind", "r.pos", "r.det", F.col("r.clitic.lemma").alias("clitic_lemma"), F.col("r.clitic.morph").alias("clitic_morph"), F.col("r.clitic.det").alias("clitic_det"), "r.normalised")


_SELECTION = """CASE l_returnflag WHEN 'R' THEN CAST(l_linenumber AS STRING) || 'bR ' || CAST(l_linenumber + 1 AS STRING) || 'asg' WHEN 'A' THEN '  ' || CAST(l_linenumber AS STRING) || 'all' ELSE CASE l_linenumber % 3 WHEN 0 THEN 'AKK' WHEN 1 THEN '??? 0a' ELSE ' ' END END"""


@query("""SELECT l_orderkey, l_linenumber, 'analysis' AS kind, 'numeric' AS class, l_linenumber AS index, 'b' AS base_alt, 'R' AS clitic_alt, '' AS "group" FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, 'analysis', 'numeric', l_linenumber + 1, 'a', '', 'sg' FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, 'analysis', 'numeric', l_linenumber, '', '', 'all' FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT l_orderkey, l_linenumber, 'unknown', 'unknown+numeric', 0, 'a', '', '' FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber % 3 = 1
UNION ALL SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'AKK' ELSE 'none' END, CASE WHEN l_linenumber % 3 = 0 THEN 'special' ELSE 'empty' END, NULL, NULL, NULL, NULL FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber % 3 <> 1""")
def selection_parse(spark, sf_dir):
    raw = F.expr(_SELECTION)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parsers.selection_kind(raw).alias("kind"), parsers.selector_class(raw).alias("class"), F.explode_outer(parsers.selectors(raw)).alias("s"))
    return rows.select("l_orderkey", "l_linenumber", "kind", "class", "s.index", "s.base_alt", "s.clitic_alt", "s.group")


@query("""WITH s AS (SELECT l_orderkey AS word, l_linenumber AS idx FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey, l_linenumber + 1 FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A')
SELECT s.word, s.idx AS "index", string_agg(CAST(s.idx AS VARCHAR), ' ') AS tokens, count(*) AS n FROM s JOIN lineitem l ON l.l_orderkey = s.word AND l.l_linenumber = s.idx GROUP BY s.word, s.idx""")
def selected_edges(spark, sf_dir):
    """One edge for each word and analysis that its selections name; selectors of analyses that aren't there drop out."""
    lines = table(spark, sf_dir, "lineitem")
    raw = F.expr(_SELECTION)
    chosen = lines.where(parsers.selection_kind(raw) == "analysis").select(F.col("l_orderkey").alias("word"), F.explode(parsers.selectors(raw)).alias("s"))
    there = lines.select(F.col("l_orderkey").alias("_w"), F.col("l_linenumber").alias("_i"))
    kept = chosen.join(there, (F.col("word") == F.col("_w")) & (F.col("s.index") == F.col("_i")))
    return kept.groupBy("word", F.col("s.index").alias("index")).agg(F.array_join(F.sort_array(F.collect_list(F.col("s.index").cast("string"))), " ").alias("tokens"), F.count("*").alias("n"))


@query("SELECT p_partkey, [2, 10, 11] AS indices, ['two', p_name, 'x'] AS given, '1' AS chosen FROM part")
def attribute_scan(spark, sf_dir):
    blob = F.concat(F.lit("mrp10=\""), F.col("p_name"), F.lit("\" mrp2='two' mrp0sel = \"1\" mrp11=\"x\" mrp2=\"again\" mrpx=\"y\""))
    rows = table(spark, sf_dir, "part").select("p_partkey", parsers.attributes(blob).alias("a"))
    found = parsers.numbered(F.col("a"))
    return rows.select("p_partkey", found["index"].alias("indices"), found["value"].alias("given"), F.col("a")["mrp0sel"].alias("chosen"))


_CU = "repeat('𒀀', p_size % 4) || ' ?' || '|' || CASE WHEN p_size % 3 = 0 THEN '?°?' ELSE '▒' END || '\u0301' || CASE WHEN p_size % 5 = 0 THEN '\U000F0001' ELSE '' END"


@query("""SELECT p_partkey, p_size % 4 + 1 + CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS points, CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS unrendered, CASE WHEN p_size % 3 = 0 THEN 0 ELSE 1 END AS lost, p_size % 3 <> 0 AS script,
 CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS private, CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS unmapped FROM part""")
def codepoint_split(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_CU).alias("cu"))
    points = parsers.codepoints(F.col("cu"))
    private = parsers.private_use(F.col("cu"), F.array(F.lit("\U000F0002")))
    count = lambda sign: F.size(F.filter(points, lambda c: c == sign))
    return rows.select("p_partkey", F.size(points).alias("points"), count("\ufffd").alias("unrendered"), count("▒").alias("lost"), parsers.is_script(F.array_join(points, "")).alias("script"), private["total"].alias("private"), private["unmapped"].alias("unmapped"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 1 AND 39 THEN repeat('𒌋', CAST(floor(l_quantity / 10) AS BIGINT)) || repeat('𒁹', CAST(l_quantity AS BIGINT) % 10) END AS signs FROM lineitem")
def numeral_rendering(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parsers.numeral(F.col("l_quantity").cast("int")).alias("signs"))


_ID = "CASE c_custkey % 6 WHEN 0 THEN c_name || '+' WHEN 1 THEN c_name || ' (+)' WHEN 2 THEN c_name || '++' WHEN 3 THEN ' ' || c_name || ' + 7' WHEN 4 THEN '' ELSE 'Ä ' || c_name END"


@query("""WITH r AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_name WHEN 3 THEN c_name || ' + 7' WHEN 5 THEN 'Ä ' || c_name END AS lookup,
 CASE c_custkey % 6 WHEN 0 THEN ['plus'] WHEN 1 THEN ['plus', 'bracket'] WHEN 2 THEN ['plus'] WHEN 3 THEN ['padded', 'plus'] WHEN 4 THEN ['empty'] ELSE ['not_ascii'] END AS flags FROM customer)
SELECT *, CASE WHEN lookup IS NOT NULL THEN 'https://example.org/r?d=' || replace(replace(replace(replace(lookup, 'Ä', '%C3%84'), '+', '%2B'), ' ', '%20'), '#', '%23') END AS link FROM r""")
def identifier_lookup(spark, sf_dir):
    raw = F.expr(_ID)
    rows = table(spark, sf_dir, "customer").select("c_custkey", parsers.lookup_id(raw).alias("lookup"), parsers.identifier_flags(raw).alias("flags"))
    return rows.select("*", parsers.web_link("https://example.org/r", F.col("lookup")).alias("link"))


@query("SELECT n, link FROM (SELECT DISTINCT regexp_replace(upper(s_name), '^SUPPLIER#0*', '') AS lookup FROM supplier) JOIN (SELECT lookup, count(*) AS n, CASE WHEN count(*) = 1 THEN 'https://example.org/r?d=' || lookup END AS link FROM (SELECT regexp_replace(upper(s_name), '^SUPPLIER#0*', '') AS lookup FROM supplier UNION ALL SELECT regexp_replace(upper(c_name), '^CUSTOMER#0*', '') FROM customer WHERE c_custkey % 3 = 0) GROUP BY lookup) USING (lookup)")
def web_links(spark, sf_dir):
    """A link only where an identifier is the only one of its normal form."""
    key = lambda c: F.regexp_replace(F.upper(c), "^(?:SUPPLIER|CUSTOMER)#0*", "").alias("lookup")
    ids = table(spark, sf_dir, "supplier").select(key("s_name"), F.lit(True).alias("own")).unionByName(table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(key("c_name"), F.lit(False).alias("own")))
    each = ids.groupBy("lookup").agg(F.count("*").alias("n"), F.bool_or("own").alias("own")).where("own")
    return each.select("n", F.when(F.col("n") == 1, parsers.web_link("https://example.org/r", F.col("lookup"))).alias("link"))


@query("""SELECT conv_id, turn, role, '<p class="' || CASE WHEN role = 'user' THEN 'user' ELSE 'other' END || CASE WHEN length(text) > 200 THEN ' long' ELSE '' END || '">' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</p>' AS html FROM conversations""")
def safe_rendering(spark, sf_dir):
    classes = parsers.class_list({"user": F.col("role") == "user", "other": F.col("role") != "user", "long": F.length("text") > 200})
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.concat(F.lit('<p class="'), classes, F.lit('">'), parsers.html_safe(F.col("text")), F.lit("</p>")).alias("html"))


@query("""SELECT p_partkey, p_size % 3 + 1 AS marks, p_brand AS reading, CASE p_size % 2 WHEN 0 THEN '(_)' ELSE '˽〈〉' END AS symmark, CASE p_size % 3 WHEN 0 THEN ['direct'] WHEN 1 THEN ['direct', 'indirect'] ELSE ['direct', 'indirect', 'double'] END AS joins,
 '€' || CAST(p_size AS VARCHAR) || ' b' AS siglum, 'ša₂ṭḫ' AS key, 'brixt' AS caption FROM part""")
def editorial_marks(spark, sf_dir):
    size = F.col("p_size")
    marked = F.when(size % 2 == 0, F.concat(F.lit("("), F.col("p_brand"), F.lit("_)"))).otherwise(F.concat(F.lit("˽"), F.col("p_brand"), F.lit("〈〉")))
    joined = F.concat(F.lit("A + B"), F.when(size % 3 > 0, " (+) C").otherwise(""), F.when(size % 3 == 2, " ++ D a+b").otherwise(" a+b"))
    stripped, marks = parsers.strip_marks(marked), parsers.join_marks(joined)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(marks).alias("marks"), stripped["reading"].alias("reading"), stripped["symmark"].alias("symmark"), marks.alias("joins"), parsers.siglum(F.concat(F.lit(" €  "), size.cast("string"), F.lit("   b "))).alias("siglum"), parsers.reading_key(F.lit("Sza2t,h")).alias("key"), parsers.undamaged(F.lit("pri%t")).alias("caption"))


@query("SELECT doc_id, sha1('blob ' || CAST(octet_length(encode(text)) AS VARCHAR) || chr(0) || text) AS blob, sha1(text) AS sha1, md5(text) AS md5 FROM documents")
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", parsers.blob_sha1(F.col("text")).alias("blob"), F.sha1("text").alias("sha1"), F.md5("text").alias("md5"))


_K2 = "CAST(o_orderkey AS STRING)"
_BROKEN = f"""CASE o_orderkey % 11 WHEN 0 THEN '<d><w t="' || {_K2} || '">x</w></d>' WHEN 1 THEN '<d><kap c-"pri%t' || {_K2} || '"</d>' WHEN 2 THEN '<d><text:line-break ' || {_K2} || '</d>' WHEN 3 THEN '<d><w t="a<parser_error>' || {_K2} || '</parser_error>c"/></d>'
 WHEN 4 THEN '<d><w t="' || {_K2} || '" t="' || {_K2} || '"/></d>' WHEN 5 THEN '<d><w <w t="' || {_K2} || '"/></d>' WHEN 6 THEN '<d><w t="pan- <' || {_K2} || '"/></d>' WHEN 7 THEN '<d><w><k>' || {_K2} || '</w></k></d>' WHEN 8 THEN '<d><w lnr="' || {_K2} || '"/1"/></d>'
 WHEN 9 THEN '<d><w trans="' || {_K2} || '"' || chr(39) || ' a="y"/></d>' ELSE '<d></w>' || {_K2} || '</d>' END"""


@query("""SELECT o_orderkey, CASE k WHEN 0 THEN '<d><w t="' || s || '">x</w></d>' WHEN 1 THEN '<d><gap c="brixt' || s || '"/></d>' WHEN 2 THEN '<d><text:line-break/> ' || s || '</d>' WHEN 3 THEN '<d><w t="a' || s || 'c"/></d>' WHEN 7 THEN '<d><w><k>' || s || '</k></w></d>'
 WHEN 6 THEN '<d><w t="pan- &lt;' || s || '"/></d>' WHEN 8 THEN '<d><w lnr="' || s || '&quot;/1"/></d>' WHEN 9 THEN '<d><w trans="' || s || '" a="y"/></d>' WHEN 10 THEN '<d>' || s || '</d>' ELSE '<d><w t="' || s || '"/></d>' END AS content, true AS ok,
 CASE k WHEN 0 THEN 'none' WHEN 1 THEN 'corrupt gap' WHEN 2 THEN 'unclosed line break' WHEN 3 THEN 'error element' WHEN 4 THEN 'attribute given twice' WHEN 5 THEN 'stray tag opening' WHEN 6 THEN 'unescaped < in an attribute' WHEN 7 THEN 'crossing elements+end without a start'
 WHEN 8 THEN 'unescaped quote in an attribute' WHEN 9 THEN 'stray quote after an attribute' ELSE 'end without a start' END AS reasons, true AS replays FROM (SELECT o_orderkey, o_orderkey % 11 AS k, CAST(o_orderkey AS VARCHAR) AS s FROM orders)""")
def text_repair(spark, sf_dir):
    """Broken records, repaired, and their patches applied again to the records as they were."""
    broken = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_BROKEN).alias("content"))
    done = repair.repaired(broken, "o_orderkey", "content")
    again = repair.replayed(broken, done, "o_orderkey", "content").select(F.col("key").alias("_k"), F.col("content").alias("_c"))
    both = done.join(again, F.col("key") == F.col("_k"))
    reasons = F.coalesce(F.nullif(F.array_join(F.transform("patches", lambda p: p["reason"]), "+"), F.lit("")), F.lit("none"))
    return both.select(F.col("key").alias("o_orderkey"), F.decode("content", "utf-8").alias("content"), "ok", reasons.alias("reasons"), (F.col("content") == F.col("_c")).alias("replays"))


@query("""SELECT CASE k WHEN 1 THEN 'corrupt gap' WHEN 2 THEN 'unclosed line break' WHEN 3 THEN 'error element' WHEN 4 THEN 'attribute given twice' WHEN 5 THEN 'stray tag opening' WHEN 6 THEN 'unescaped < in an attribute' WHEN 7 THEN 'crossing elements' WHEN 8 THEN 'unescaped quote in an attribute'
 WHEN 9 THEN 'stray quote after an attribute' ELSE 'end without a start' END AS reason, CASE WHEN k IN (7, 10) THEN 'recovery' WHEN k = 9 THEN 'unlisted' ELSE 'mechanical' END AS lane, CAST(sum(n) AS BIGINT) AS n FROM (SELECT o_orderkey % 11 AS k, 1 AS n FROM orders WHERE o_orderkey % 11 > 0 UNION ALL SELECT 10, 1 FROM orders WHERE o_orderkey % 11 = 7) GROUP BY reason, lane""")
def repair_lanes(spark, sf_dir):
    """Patches by the lane that a reviewed list gives them; one reason isn't reviewed."""
    broken = spread(table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_BROKEN).alias("content")))
    patches = written(repair.repaired(broken, "o_orderkey", "content").select("key", F.explode("patches.reason").alias("reason")), "patches")
    lane = F.when(F.col("reason").isin("crossing elements", "end without a start"), "recovery").otherwise("mechanical")
    reviewed = patches.where("reason <> 'stray quote after an attribute'").select("key", "reason", lane.alias("lane")).distinct()
    return repair.lanes(patches, reviewed).groupBy("reason", "lane").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, substr(content, 4, length(content) - 7) AS inner, length(content) AS size FROM (SELECT o_orderkey, '<d>' || o_orderstatus || CAST(o_custkey AS VARCHAR) || '</d>' AS content FROM orders)")
def span_slice(spark, sf_dir):
    data = F.encode(F.concat(F.lit("<d>"), "o_orderstatus", F.col("o_custkey").cast("string"), F.lit("</d>")), "utf-8")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", data.alias("c"))
    return rows.select("o_orderkey", F.decode(corpus.sliced(F.col("c"), F.lit(3), F.octet_length("c") - 4), "utf-8").alias("inner"), F.octet_length("c").cast("long").alias("size"))


@query("SELECT page_id, row_number() OVER (ORDER BY lower(u), u) AS ordinal, u AS src_file FROM (SELECT page_id, 'p/' || CAST(page_id % 7 AS VARCHAR) || '/' || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 2 = 0 THEN 'É' ELSE 'e' END || '.xml' AS u FROM pages)")
def corpus_order(spark, sf_dir):
    """Stable keys in Unicode's composed form, and their places in the folded order."""
    raw = F.concat(F.lit("file:/c/p/"), (F.col("page_id") % 7).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, "E\u0301").otherwise("e"), F.lit(".xml"))
    files = table(spark, sf_dir, "pages").select("page_id", corpus.stable_key(raw, "/c").alias("src_file"))
    return corpus.ordinals(files).select("page_id", F.col("ordinal").cast("long").alias("ordinal"), "src_file")


@query("SELECT reading, sequence, CAST(count(*) OVER (PARTITION BY reading) AS BIGINT) AS n, CASE WHEN reading = '' THEN 'empty' WHEN sequence = '' THEN 'unusable' WHEN count(*) OVER (PARTITION BY reading) > 1 THEN 'duplicate' END AS fault FROM (SELECT CASE WHEN p_size = 1 THEN '' ELSE p_type END AS reading, CASE WHEN p_size = 2 THEN '' ELSE p_brand END AS sequence FROM part)")
def map_integrity(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    lines = part.select(F.concat_ws("\t", F.when(F.col("p_size") == 1, "").otherwise(F.col("p_type")), F.when(F.col("p_size") == 2, "").otherwise(F.col("p_brand"))).alias("value")).unionByName(part.limit(1).select(F.lit("# a comment").alias("value")))
    return corpus.entries(lines)


@query("""SELECT k AS src_file, CASE WHEN k % 7 = 0 THEN 'unexpected' WHEN k % 5 = 0 THEN 'missing' WHEN k % 11 = 0 THEN 'unlocked' WHEN k % 3 = 0 THEN 'altered' ELSE 'ok' END AS status FROM (SELECT doc_id AS k FROM documents WHERE NOT (doc_id % 7 = 0 AND doc_id % 5 = 0))""")
def locked_acquisition(spark, sf_dir):
    """Files against a lock list; the modulos make the faults."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("src_file"), F.encode("text", "utf-8").alias("content"))
    lock = docs.where("src_file % 7 <> 0").select("src_file", F.when(F.col("src_file") % 11 == 0, None).when(F.col("src_file") % 3 == 0, "0").otherwise(F.sha2("content", 256)).alias("sha256"))
    return corpus.verified(docs.where("src_file % 5 <> 0"), lock)


@query("SELECT o_custkey AS src, o_orderkey AS dst, o_orderstatus AS value FROM orders WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders GROUP BY o_custkey, o_orderkey)")
def edge_roundtrip(spark, sf_dir):
    """A valued edge feature written as lines and read back."""
    from ..sources import features

    edges = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.col("o_orderstatus").alias("value"))
    lines = features.edge_lines(edges, valued=True)
    part = F.floor(F.col("first") / 4096)
    files = lines.groupBy(part.alias("part")).agg(F.concat(F.lit("@edge\n@edgeValues\n\n"), F.array_join(F.array_sort(F.collect_list(F.struct("first", "line")))["line"], "\n"), F.lit("\n")).alias("content"))
    return features.read_edges(files, "part", valued=True).select("src", "dst", "value")


_UNMARKED = "'<sGr>A ' || CAST(o_custkey AS STRING) || '</sGr><del_in/>' || CASE o_orderkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN '' WHEN 2 THEN '<lb/>' ELSE '<d>' END || 'x ' || o_orderstatus || '<del_fin/> '"


@query("""WITH h AS (SELECT o_orderkey, o_orderkey % 4 AS k, CAST(22 + length(CAST(o_custkey AS VARCHAR)) AS BIGINT) AS h FROM orders)
SELECT o_orderkey, 'framing lb' AS fault, NULL AS ord, NULL AS "start", NULL AS "end" FROM h WHERE k = 2 UNION ALL SELECT o_orderkey, 'unclosed d', NULL, NULL, NULL FROM h WHERE k = 3
UNION ALL SELECT o_orderkey, NULL, 0, 0, CASE k WHEN 0 THEN h ELSE h + 1 END FROM h WHERE k < 2 UNION ALL SELECT o_orderkey, NULL, 1, h, h + 2 FROM h WHERE k = 0
UNION ALL SELECT o_orderkey, NULL, 2, h + 2, h + 15 FROM h WHERE k = 0 UNION ALL SELECT o_orderkey, NULL, 1, h + 1, h + 14 FROM h WHERE k = 1""")
def unmarked_words(spark, sf_dir):
    """Words of lines that mark none, by their byte ranges; two kinds of lines can't be read so."""
    lines = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_UNMARKED).alias("line"))
    found = markup.unmarked_words(lines, "o_orderkey", "line")
    return found.select(F.col("key").alias("o_orderkey"), "fault", F.posexplode_outer("groups").alias("ord", "g")).select("o_orderkey", "fault", "ord", "g.start", "g.end")


@query("""SELECT o_orderkey, status, CASE WHEN status = 'ok' THEN '<d><w t="a' || s || 'c"/></w></d>' END AS content, CASE WHEN status = 'ok' THEN 1 END AS left_over FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS s,
 CASE o_orderkey % 7 WHEN 1 THEN 'not in the manifest' WHEN 2 THEN 'text changed' WHEN 3 THEN 'patches changed' WHEN 4 THEN 'places not exact' WHEN 5 THEN 'no recovery event' WHEN 6 THEN 'text missing' ELSE 'ok' END AS status FROM orders)""")
def prepared_sources(spark, sf_dir):
    """Texts with a mechanical and a recovery patch, some of which no longer are what was reviewed."""
    k, s = F.col("o_orderkey") % 7, F.col("o_orderkey").cast("string")
    bad = F.concat(F.lit('<d><w t="a<parser_error>'), s, F.lit('</parser_error>c"/></w></d>'))
    texts = table(spark, sf_dir, "orders").select("o_orderkey", bad.alias("content"))
    done = repair.repaired(texts, "o_orderkey", "content").drop("content")
    place = F.transform("patches", lambda p, i: F.struct(p["reason"].alias("reason"), (i + 1).alias("i")))

    def lane(mechanical: bool):
        return F.transform(F.filter(place, lambda p: (p["reason"] == "error element") == F.lit(mechanical)), lambda p: p["i"])

    k2 = F.col("key") % 7
    policy = done.select("key", F.when(k2 == 2, F.lit("0")).otherwise(F.col("sha256")).alias("sha256"), F.when(k2 == 3, F.lit("0")).otherwise(repair.fingerprint(F.col("patches"))).alias("fingerprint"), lane(True).alias("mechanical"), F.when(k2 != 4, lane(False)).alias("recovery"), F.when(k2 != 5, F.array(F.lit("lost word"))).alias("events"))
    out = repair.prepared(texts.where(k != 6), done.where(k2 != 1), policy, "o_orderkey", "content")
    return out.select(F.col("key").alias("o_orderkey"), "status", F.decode("content", "utf-8").alias("content"), F.when(F.col("recovery").isNotNull(), F.size("recovery")).alias("left_over"))
