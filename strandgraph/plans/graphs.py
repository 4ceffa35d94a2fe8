"""Queries over nodes and edges, on the relational tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import align, stats, template
from ..sources import corpus
from ..sources.tables import dealt, table
from .registry import query


def _types(spark, sf_dir):
    names = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "order": "o_orderkey", "line": "line_key"}
    line = table(spark, sf_dir, "lineitem").withColumn("line_key", F.struct("l_orderkey", "l_linenumber"))
    types = {"region": table(spark, sf_dir, "region"), "nation": table(spark, sf_dir, "nation"), "customer": table(spark, sf_dir, "customer"), "order": table(spark, sf_dir, "orders"), "line": line}
    links = {("region", "nation"): "n_regionkey", ("nation", "customer"): "c_nationkey", ("customer", "order"): "o_custkey", ("order", "line"): "l_orderkey"}
    return types, names, links


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_quantity > 45")
def template_contain(spark, sf_dir):
    return template.search("order o_orderstatus=F\n  line l_quantity>45", *_types(spark, sf_dir)).select("o_orderkey", "line_key.l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def template_without(spark, sf_dir):
    return template.search("order o_orderstatus=O\n/without/\n  line l_returnflag=R\n/-/", *_types(spark, sf_dir))


@query("SELECT o_orderkey, count(*) AS hits FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 40 GROUP BY o_orderkey ORDER BY o_orderkey LIMIT 50 OFFSET 20")
def template_condensed(spark, sf_dir):
    return template.condense(template.search("order\n  line l_quantity>40", *_types(spark, sf_dir)), "o_orderkey", 20, 50)


@query("SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def edge_forward(spark, sf_dir):
    return template.search("customer c_mktsegment=BUILDING\n  order", *_types(spark, sf_dir))


@query("SELECT o_orderkey, c_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000")
def edge_backward(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_orderkey", "o_custkey")
    return orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "c_nationkey")


@query("SELECT r_name, count(*) AS n, count(DISTINCT c_custkey) AS customers FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY r_name")
def edge_multihop(spark, sf_dir):
    found = template.search("region\n  nation\n    customer\n      order", *_types(spark, sf_dir))
    return found.join(table(spark, sf_dir, "region"), "r_regionkey").groupBy("r_name").agg(F.count("*").alias("n"), F.countDistinct("c_custkey").alias("customers"))


@query("SELECT key, value, top_obs, total_obs, round(CAST(top_obs AS DOUBLE) / total_obs, 6) AS confidence FROM (SELECT p_brand AS key, l_returnflag AS value, n AS top_obs, CAST(sum(n) OVER (PARTITION BY p_brand) AS BIGINT) AS total_obs, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, l_returnflag) AS r FROM (SELECT p_brand, l_returnflag, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)) WHERE r = 1 AND total_obs >= 5")
def learn_map(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return stats.modal(rows, "p_brand", "l_returnflag", 5).withColumnRenamed("p_brand", "key").select("key", "value", "top_obs", "total_obs", "confidence")


_TURNS = "(SELECT conv_id, turn, w, lead(w) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS v FROM (SELECT conv_id, turn, role, text, regexp_extract_all(text, '[^ ]+') AS w FROM conversations))"


def _turns(spark, sf_dir):
    w = F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", w.alias("w"), F.lead(w).over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).alias("v"))


@query(f"SELECT conv_id, turn, CAST(i AS INTEGER) AS pos, w[i] AS a, v[i] AS b FROM (SELECT conv_id, turn, w, v, unnest(range(1, len(w) + 1)) AS i FROM {_TURNS} WHERE len(w) = len(v))")
def zip_align(spark, sf_dir):
    pairs = _turns(spark, sf_dir).where("size(w) = size(v)").select("conv_id", "turn", F.posexplode(F.arrays_zip("w", "v")).alias("p", "x"))
    return pairs.select("conv_id", "turn", (F.col("p") + 1).alias("pos"), F.col("x.w").alias("a"), F.col("x.v").alias("b"))


@query(f"SELECT level, count(*) AS n FROM (SELECT CASE WHEN v IS NULL THEN 'none' WHEN len(w) = len(v) THEN 'zip' WHEN len(w) < len(v) THEN 'absorb' ELSE 'expand' END AS level FROM {_TURNS}) GROUP BY level")
def align_levels(spark, sf_dir):
    return _turns(spark, sf_dir).groupBy(align.level(F.col("w"), F.col("v")).alias("level")).agg(F.count("*").alias("n"))


@query("SELECT l.doc_id, d.source, quality AS selected FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE quality = 1")
def selection_edges(spark, sf_dir):
    chosen = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.col("quality").alias("selected"))
    return chosen.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


@query("SELECT l_orderkey, count(*) AS candidates FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def ambiguity_atlas(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("candidates")).where("candidates > 1")


@query("WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, count(*) AS candidates, CAST(sum(n) AS BIGINT) AS total, round(greatest(0, log2(sum(n)) - sum(n * log2(n)) / sum(n)), 6) AS entropy FROM c GROUP BY l_suppkey")
def ambiguity_entropy(spark, sf_dir):
    return stats.entropy(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag"), "l_suppkey", "l_returnflag")


@query("SELECT a.l_partkey AS a, b.l_partkey AS b, count(*) AS weight FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2")
def cooccurrence_network(spark, sf_dir):
    """The join is dealt into parts of a bounded number of rows, so a task's pairs are too."""
    line = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), 500_000, "l_orderkey")
    a, b = (line.withColumnRenamed("l_partkey", n) for n in "ab")
    return a.join(b.hint("merge"), "l_orderkey").where("a < b").groupBy("a", "b").agg(F.count("*").alias("weight"))


@query("SELECT l_orderkey, l_suppkey, min(l_returnflag) AS kind FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) = 1")
def joined_projection(spark, sf_dir):
    kinds = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.min("l_returnflag").alias("kind"), F.max("l_returnflag").alias("other"))
    return kinds.where("kind = other").drop("other")


@query("SELECT DISTINCT l_orderkey, p_brand, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, p_brand) = 1 THEN 'unique' ELSE 'ambiguous' END AS resolution FROM lineitem JOIN part ON p_partkey = l_partkey")
def witness_resolution(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("l_orderkey", "p_brand").agg(F.when(F.count("*") == 1, "unique").otherwise("ambiguous").alias("resolution"))


@query("SELECT doc_id AS id, m AS label FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS m, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1")
def equivalence_classes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("b"))
    return stats.min_label_components(docs.join(first, "h").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('5:' || CAST(doc_id AS VARCHAR))) AS r FROM documents) WHERE r <= 5")
def stratified_sample(spark, sf_dir):
    return stats.stratified(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 5, "5").drop("rank")


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR), doc_id) AS n FROM documents) WHERE (n - 1) % 20 = 0")
def systematic_sample(spark, sf_dir):
    """Every 20th document in the order of its name: the sampling is the operator."""
    named = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), "doc_id", "source")
    return corpus.ordinals(named, "name", ("doc_id", "source")).where("(ordinal - 1) % 20 = 0").select("doc_id", "source")


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN l_quantity END DESC NULLS LAST, l_linenumber) AS place FROM lineitem")
def rank_candidates(spark, sf_dir):
    known = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(known.desc_nulls_last(), "l_linenumber")).alias("place"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 2")
def topk_per_group(spark, sf_dir):
    return stats.top_k(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2).drop("rank")


@query("SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 2) AS median FROM orders GROUP BY o_orderpriority")
def percentiles(spark, sf_dir):
    return stats.quantile(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", 0.5).select("o_orderpriority", F.round("quantile", 2).alias("median"))
