"""Audit queries: each has an answer that an independent derivation must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, text
from ..sources.tables import table
from .registry import query


@query("SELECT 'documents' AS otype, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def census(spark, sf_dir):
    parts = [table(spark, sf_dir, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("otype"), "n") for n in ("documents", "pages", "orders", "lineitem", "events")]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ROLLUP (lang, source)")
def census_rollup(spark, sf_dir):
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def census_cube(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b FROM (SELECT o_orderkey AS k, count(*) AS n_a FROM orders GROUP BY 1) a FULL JOIN (SELECT DISTINCT l_orderkey AS k, 1 AS n_b FROM lineitem) b ON a.k = b.k WHERE coalesce(n_a, 0) <> coalesce(n_b, 0)")
def bag_equal(spark, sf_dir):
    """The bag audit on the keys themselves: every order without lineitems, and the reverse, by its key."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    b = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    return audit.bag_diff(a, b, ["k"])


@query("SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity < 25 EXCEPT ALL SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity >= 25")
def bag_except(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.where("l_quantity < 25").select("l_suppkey", "l_returnflag").exceptAll(rows.where("l_quantity >= 25").select("l_suppkey", "l_returnflag"))


@query("SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS split_lines, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS line_ends, CAST(len(string_split(text, chr(10))) AS BIGINT) AS emitted, true AS balanced FROM documents")
def conservation_three_way(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    split = docs.select("doc_id", F.size(F.split("text", "\n")).alias("n"))
    ends = docs.select("doc_id", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n"))
    emitted = text.lines(docs).groupBy("doc_id").agg(F.count("*").alias("n"))
    return audit.conserved({"split_lines": split, "line_ends": ends, "emitted": emitted}, "doc_id")


_DECLARED = ["html", "head", "body", "meta", "title", "style", "script", "nav", "ul", "li", "a", "div", "article", "h1", "p", "table", "footer"]


@query(f"WITH o AS (SELECT DISTINCT lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages), d AS (SELECT unnest({_DECLARED}) AS tag) SELECT tag, 'undeclared' AS status FROM o WHERE tag NOT IN (SELECT tag FROM d) UNION ALL SELECT tag, 'unobserved' FROM d WHERE tag NOT IN (SELECT tag FROM o)")
def vocab_drift(spark, sf_dir):
    observed = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))).alias("t")).select(F.lower("t").alias("tag"))
    return audit.drift(observed, spark.createDataFrame([(t,) for t in _DECLARED], "tag string"), "tag")


@query("SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text)) AS size FROM documents")
def identity_manifest(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"))


@query("""SELECT source, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(r, '' ORDER BY part)) AS digest FROM (SELECT source, doc_id // 4096 AS part, count(*) AS n, sha256(string_agg(d, '' ORDER BY doc_id)) AS r FROM
 (SELECT source, doc_id, sha256(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS d FROM documents) GROUP BY 1, 2) GROUP BY source""")
def fingerprint(spark, sf_dir):
    return audit.fingerprint(table(spark, sf_dir, "documents"), "doc_id", ["doc_id", "lang", "text"], ["source"])


@query("""SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'missing' WHEN a.doc_id IS NULL THEN 'unexpected' WHEN a.m IS DISTINCT FROM b.m THEN 'altered' ELSE 'same' END AS status
FROM (SELECT doc_id, sha256(text) AS m FROM documents WHERE doc_id % 7 <> 0) a FULL JOIN (SELECT doc_id, sha256(CASE WHEN doc_id % 11 = 0 THEN text || '!' ELSE text END) AS m FROM documents WHERE doc_id % 5 <> 0) b ON a.doc_id = b.doc_id""")
def manifest_diff(spark, sf_dir):
    """Two snapshots made from the whole table, compared; the modulos make the snapshots differ."""
    docs = table(spark, sf_dir, "documents")
    a = docs.where("doc_id % 7 <> 0").select("doc_id", F.sha2("text", 256).alias("m"))
    b = docs.where("doc_id % 5 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("m"))
    return audit.snapshot_diff(a, b, "doc_id", "m")


@query("SELECT before, after, CASE WHEN before IS NOT DISTINCT FROM after THEN 'unchanged' WHEN before IS NULL THEN 'added' WHEN after IS NULL THEN 'withdrawn' ELSE 'replaced' END AS kind, count(*) AS n FROM (SELECT nullif(o_orderstatus, 'P') AS before, CASE WHEN o_totalprice > 250000 THEN NULL WHEN o_totalprice > 100000 THEN 'F' ELSE o_orderstatus END AS after FROM orders) GROUP BY before, after, kind")
def delta_transitions(spark, sf_dir):
    after = F.when(F.col("o_totalprice") > 250000, None).when(F.col("o_totalprice") > 100000, "F").otherwise(F.col("o_orderstatus"))
    return audit.transitions(table(spark, sf_dir, "orders"), F.nullif("o_orderstatus", F.lit("P")), after)


@query("""WITH c AS (SELECT sha256(text) AS item, lang, count(DISTINCT source) AS n FROM documents GROUP BY 1, 2)
SELECT item, lang AS winner, n AS support, CAST(total - n AS BIGINT) AS against FROM (SELECT *, sum(n) OVER (PARTITION BY item) AS total, row_number() OVER (PARTITION BY item ORDER BY n DESC, lang) AS r FROM c) WHERE r = 1""")
def external_vote(spark, sf_dir):
    return audit.vote(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("item"), "source", "lang"), "item", "source", "lang")


@query("SELECT reason, count(*) AS n, CAST(sum(long) AS BIGINT) AS also_long FROM (SELECT CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN n_chars < 200 THEN 'short' WHEN text LIKE '%!!%' THEN 'shouting' WHEN text LIKE '%Licen%' THEN 'licence' ELSE 'none' END AS reason, CASE WHEN n_chars > 5000 THEN 1 ELSE 0 END AS long FROM documents) GROUP BY reason")
def gap_priority(spark, sf_dir):
    t = F.col("text")
    reason = F.when(t.isNull() | (t == ""), "empty").when(F.col("n_chars") < 200, "short").when(t.contains("!!"), "shouting").when(t.contains("Licen"), "licence").otherwise("none")
    return table(spark, sf_dir, "documents").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("n_chars") > 5000, 1).otherwise(0)).alias("also_long"))


@query("SELECT key, count(*) AS n FROM (SELECT regexp_replace(lower(c_name), '[^0-9]', '', 'g') AS key FROM customer UNION ALL SELECT regexp_replace(lower(s_name), '[^0-9]', '', 'g') FROM supplier) GROUP BY key HAVING count(*) > 1")
def id_collisions(spark, sf_dir):
    key = lambda c: F.regexp_replace(F.lower(c), "[^0-9]", "").alias("key")
    names = table(spark, sf_dir, "customer").select(key("c_name")).unionByName(table(spark, sf_dir, "supplier").select(key("s_name")))
    return names.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN len(list_distinct(sources)) > 1 THEN 'renamed' WHEN n > 1 THEN 'identical' ELSE 'single' END AS status FROM (SELECT sha256(text) AS h, list(source) AS sources, count(*) AS n FROM documents GROUP BY 1)) GROUP BY status")
def release_correspondence(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("source").alias("a"), F.max("source").alias("b"), F.count("*").alias("n"))
    return g.groupBy(F.when(F.col("a") != F.col("b"), "renamed").when(F.col("n") > 1, "identical").otherwise("single").alias("status")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, 'junk' AS reason FROM labels WHERE quality = 0 AND NOT (quality = 0 AND toxic = 1)")
def ledger_balance(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select("doc_id", F.when(F.col("quality") == 1, "converted").otherwise("excluded").alias("status"), F.when(F.col("quality") == 0, "junk").alias("reason"))
    allowed = labels.where("quality = 0 AND toxic = 1").select("doc_id", F.lit("junk").alias("reason"))
    return audit.ledger(outcomes, allowed, "doc_id").select("doc_id", "reason")


@query("SELECT source, CAST(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS toxic, CAST(sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS clean, bool_or(quality = 0) AS any_junk FROM documents JOIN labels USING (doc_id) GROUP BY source")
def damage_concordance(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.groupBy("source").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("clean"), F.bool_or(F.col("quality") == 0).alias("any_junk"))
