"""Queries of the user-facing surface: features, sections, formats, concordances, statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import audit, gazetteer, markup, ordered, render, stats, text
from ..sources import corpus, shared
from ..sources.tables import table
from .registry import query
from .texts import _WORDS, _words


@query("SELECT c_custkey AS node, row_number() OVER (ORDER BY lower(c_name), c_name) AS ordinal FROM customer")
def otype_scan(spark, sf_dir):
    """All nodes of a type in their order; of equal names the smaller node is first, as in the table."""
    return corpus.ordinals(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"), "c_name"), "c_name", ("node",)).select("node", F.col("ordinal").cast("long").alias("ordinal"))


@query("SELECT table_name AS otype, column_name AS feature FROM information_schema.columns WHERE table_name IN ('documents', 'pages', 'labels')")
def feature_list(spark, sf_dir):
    return spark.createDataFrame([(t, c) for t in ("documents", "pages", "labels") for c in table(spark, sf_dir, t).columns], "otype string, feature string")


@query("SELECT event_id, value IS NOT NULL AS present, nullif(nullif(event_type, 'error'), 'click') AS shown FROM events")
def presence_and_none(spark, sf_dir):
    """Whether a feature is there (0 is a value), and a display value without those that stand for none."""
    shown = F.when(~F.col("event_type").isin("error", "click"), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", F.col("value").isNotNull().alias("present"), shown.alias("shown"))


@query("SELECT 'lang' AS feature, coalesce(bool_or(lang IS NOT NULL), false) AS covered FROM documents WHERE doc_id BETWEEN 10 AND 20 UNION ALL SELECT 'source', coalesce(bool_or(source IS NOT NULL), false) FROM documents WHERE doc_id BETWEEN 10 AND 20 UNION ALL SELECT 'none', false")
def coverage_predicate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("doc_id BETWEEN 10 AND 20").withColumn("none", F.lit(None).cast("string"))
    return render.covered(rows, ["lang", "source", "none"])


@query("SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM (SELECT o_orderkey, o_custkey, lead(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS nxt FROM orders) a JOIN orders b ON b.o_orderkey = a.nxt JOIN customer ca ON ca.c_custkey = a.o_custkey JOIN customer cb ON cb.c_custkey = b.o_custkey WHERE ca.c_nationkey <> cb.c_nationkey")
def cross_block_violations(spark, sf_dir):
    """Statements whose ends lie in different blocks."""
    nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(nation, F.col("o_custkey") == F.col("c_custkey"))
    pairs = ordered.following(o, ["o_orderstatus"], ["o_orderkey"], ["o_orderkey", "c_nationkey"])
    return pairs.where("c_nationkey <> next.c_nationkey").select(F.col("o_orderkey").alias("a"), F.col("next.o_orderkey").alias("b"))


@query("SELECT source, CAST(sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS BIGINT) AS en, CAST(sum(CASE WHEN lang = 'de' THEN 1 ELSE 0 END) AS BIGINT) AS de, CAST(sum(CASE WHEN lang IS NULL OR lang NOT IN ('en', 'de') THEN 1 ELSE 0 END) AS BIGINT) AS other FROM documents GROUP BY source")
def pivot_count(spark, sf_dir):
    kind = F.when(F.col("lang").isin("en", "de"), F.col("lang")).otherwise("other")
    return table(spark, sf_dir, "documents").withColumn("kind", kind).groupBy("source").pivot("kind", ["en", "de", "other"]).count().na.fill(0)


@query("SELECT name, coalesce(n, 0) AS observed, expected, n IS NOT DISTINCT FROM expected AS ok FROM (SELECT r_name AS name, count(*) AS n FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1) FULL JOIN (SELECT unnest(['AFRICA', 'ASIA', 'ATLANTIS']) AS name, unnest([5, 4, 0]) AS expected) USING (name)")
def fixed_population(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("n"))
    return audit.population(n, {"AFRICA": 5, "ASIA": 4, "ATLANTIS": 0})


@query("""WITH v AS (SELECT p_type AS item, p_size % 5 AS lineage, min(CASE WHEN p_size % 3 > 0 THEN p_brand END) AS lo, max(CASE WHEN p_size % 3 > 0 THEN p_brand END) AS hi FROM part GROUP BY 1, 2), e AS (SELECT item, CASE WHEN lo = hi THEN lo END AS c FROM v), n AS (SELECT item, c, count(*) AS n FROM e WHERE c IS NOT NULL GROUP BY 1, 2)
SELECT item, count(*) AS lineages, coalesce(max(s), 0) AS support, CAST(coalesce(max(t), 0) - coalesce(max(s), 0) AS BIGINT) AS against, CAST(sum(CASE WHEN c IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unknown, max(CASE WHEN k = 1 THEN one END) AS consensus FROM e LEFT JOIN (SELECT item, max(n) AS s, sum(n) AS t, count(*) AS k, min(c) AS one FROM n GROUP BY item) USING (item) GROUP BY item""")
def lineage_vote(spark, sf_dir):
    """Sources of one lineage have one voice; the consensus is what all that know agree on."""
    ballots = table(spark, sf_dir, "part").select(F.col("p_type").alias("item"), (F.col("p_size") % 5).alias("lineage"), F.when(F.col("p_size") % 3 > 0, F.col("p_brand")).alias("choice"))
    return audit.agreement(ballots, "item", "lineage", "choice")


@query("""WITH x AS (SELECT regexp_extract_all(text, '[^ ]+') AS ws FROM conversations), i AS (SELECT ws, unnest(range(1, len(ws) + 1)) AS i FROM x), y AS (SELECT ws[i] AS a, unnest(ws[i + 1 : i + 4]) AS b FROM i), p AS (SELECT a, b, count(*) AS n FROM y GROUP BY 1, 2), fa AS (SELECT a, sum(n) AS f FROM p GROUP BY 1), fb AS (SELECT b, sum(n) AS f FROM p GROUP BY 1), t AS (SELECT CAST(sum(n) AS DOUBLE) AS t FROM p),
q AS (SELECT a, b, n, fa.f AS r, fb.f AS c, t FROM p JOIN fa USING (a) JOIN fb USING (b), t WHERE n >= 5) SELECT a, b, n, round(2 * (n * ln(n / (r * c / t)) + CASE WHEN r - n > 0 THEN (r - n) * ln((r - n) / (r * (t - c) / t)) ELSE 0 END + CASE WHEN c - n > 0 THEN (c - n) * ln((c - n) / ((t - r) * c / t)) ELSE 0 END + CASE WHEN t - r - c + n > 0 THEN (t - r - c + n) * ln((t - r - c + n) / ((t - r) * (t - c) / t)) ELSE 0 END), 4) AS g2 FROM q""")
def collocation_g2(spark, sf_dir):
    """Pairs within five words of a message, by log likelihood."""
    ws = F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0))
    rows = table(spark, sf_dir, "conversations").select(ws.alias("ws"))
    n = F.size("ws")
    shifted = [F.when(n > d, F.arrays_zip(F.slice("ws", F.lit(1), n - d).alias("a"), F.slice("ws", F.lit(d + 1), n - d).alias("b"))) for d in range(1, 5)]
    pairs = shared.written(rows.select(F.explode(F.flatten(F.array_compact(F.array(*shifted)))).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n")), "pairs")
    fa = pairs.groupBy(F.col("a").alias("a2")).agg(F.sum("n").alias("r"))
    fb = pairs.groupBy(F.col("b").alias("b2")).agg(F.sum("n").alias("c"))
    total = pairs.agg(F.sum("n").cast("double").alias("t"))
    both = pairs.where("n >= 5").join(fa, F.col("a") == F.col("a2")).join(fb, F.col("b") == F.col("b2")).join(F.broadcast(total))  # one row
    return both.select("a", "b", "n", F.round(stats.log_likelihood(F.col("n"), F.col("r"), F.col("c"), F.col("t")), 4).alias("g2"))


@query("SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'withdrawn' WHEN a.m IS DISTINCT FROM b.m THEN 'replaced' ELSE 'unchanged' END AS kind FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS m FROM orders WHERE o_orderkey % 7 > 0) a FULL JOIN (SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN NULL ELSE nullif(o_orderstatus, 'P') END AS m FROM orders WHERE o_orderkey % 5 > 0) b ON a.o_orderkey = b.o_orderkey")
def snapshot_delta(spark, sf_dir):
    """Two snapshots of the whole table, which the modulos make differ, compared key by key."""
    o = table(spark, sf_dir, "orders").withColumn("m", F.nullif("o_orderstatus", F.lit("P")))
    return audit.delta(o.where("o_orderkey % 7 > 0"), o.where("o_orderkey % 5 > 0").withColumn("m", F.when(F.col("o_totalprice") > 200000, None).otherwise(F.col("m"))), "o_orderkey", "m")


@query("SELECT w.conv_id, w.turn, c.role AS node, count(c.role) OVER (PARTITION BY w.conv_id, w.turn) > 1 AS ambiguous FROM (SELECT DISTINCT conv_id, unnest([1, 2, 999]) AS turn FROM conversations) w LEFT JOIN conversations c ON c.conv_id = w.conv_id AND c.turn = w.turn")
def section_addresses(spark, sf_dir):
    """Addresses looked up; some name nothing."""
    rows = table(spark, sf_dir, "conversations")
    wanted = rows.select("conv_id").distinct().select("conv_id", F.explode(F.array(*[F.lit(i).cast("long") for i in (1, 2, 999)])).alias("turn"))
    return render.lookup(rows, wanted, ["conv_id", "turn"], "role")


@query(f"SELECT doc_id, line, string_agg(word || '/' || CAST(pos AS VARCHAR) || ' ', '' ORDER BY pos) AS rendered FROM ({_WORDS}) GROUP BY doc_id, line")
def text_format(spark, sf_dir):
    """Whole texts come together by their document; their lines are rendered where they stand."""
    docs = table(spark, sf_dir, "documents").groupBy("doc_id").agg(F.collect_list("text").alias("texts"))
    lines = F.transform("texts", lambda t: F.transform(F.split(t, "\n"), lambda x: F.regexp_extract_all(x, F.lit("[^ ]+"), F.lit(0))))
    return render.listed(docs, "doc_id", lines, "line", "pos", "word", "{word}/{pos} ")


@query("SELECT conv_id, string_agg(coalesce(role, '') || '#' || text || ' ', '' ORDER BY turn) AS rendered FROM conversations GROUP BY conv_id")
def text_format_level(spark, sf_dir):
    """A format that chooses the level of turns."""
    return render.rendered({"turn": table(spark, sf_dir, "conversations")}, "conv_id", "turn", "turn#{role/conv_id}#{text} ")


@query("SELECT DISTINCT p_brand AS lemma, l_orderkey AS word, o_orderkey AS line, c_name AS doc FROM part JOIN lineitem ON l_partkey = p_partkey LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' LEFT JOIN customer ON c_custkey = o_custkey WHERE p_size < 5")
def lemma_concordance(spark, sf_dir):
    """Lemma to analyses to words, each word once, with its line where there is one."""
    lemma = table(spark, sf_dir, "part").where("p_size < 5").select("p_partkey", F.col("p_brand").alias("lemma"))
    words = lemma.join(table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_orderkey").alias("word")), F.col("l_partkey") == F.col("p_partkey")).select("lemma", "word").distinct()
    lines = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("line"), "o_custkey")
    docs = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("doc"))
    return words.join(lines, F.col("word") == F.col("line"), "left").join(docs, F.col("o_custkey") == F.col("c_custkey"), "left").select("lemma", "word", "line", "doc")


@query(f"SELECT source, CAST(sum(CASE WHEN digit AND long THEN 1 ELSE 0 END) AS BIGINT) AS both, CAST(sum(CASE WHEN digit AND NOT long THEN 1 ELSE 0 END) AS BIGINT) AS digit_only, CAST(sum(CASE WHEN long AND NOT digit THEN 1 ELSE 0 END) AS BIGINT) AS long_only, count(*) AS words FROM (SELECT doc_id, regexp_matches(word, '[0-9]') AS digit, length(word) > 10 AS long FROM ({_WORDS})) JOIN documents USING (doc_id) GROUP BY source")
def flag_contingency(spark, sf_dir):
    """Words of each source by two flags; counted per document before the join."""
    digit, long_ = F.col("word").rlike("[0-9]"), F.length("word") > 10
    each = _words(spark, sf_dir).groupBy("doc_id").agg(F.count_if(digit & long_).alias("both"), F.count_if(digit & ~long_).alias("digit_only"), F.count_if(~digit & long_).alias("long_only"), F.count("*").alias("words"))
    return each.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").groupBy("source").agg(*[F.sum(c).alias(c) for c in ("both", "digit_only", "long_only", "words")])


@query("SELECT o_orderkey, o_custkey, lag(o_orderstatus) OVER w AS prev, lead(o_orderstatus) OVER w AS next, row_number() OVER w AS candidate, o_totalprice = max(o_totalprice) OVER (PARTITION BY o_custkey) AS label FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
def candidate_frame(spark, sf_dir):
    """A row for each candidate with its neighbours and whether it is the chosen one."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    best = F.max("o_totalprice").over(Window.partitionBy("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.lag("o_orderstatus").over(w).alias("prev"), F.lead("o_orderstatus").over(w).alias("next"), F.row_number().over(w).alias("candidate"), (F.col("o_totalprice") == best).alias("label"))


@query("""WITH s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^ \\n]+') AS w FROM documents))), b AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT item_id, regexp_extract_all(text, '[^ \\n]+') AS w FROM benchmark))),
j AS (SELECT item_id, doc_id, count(*) AS n FROM s JOIN b USING (g) GROUP BY 1, 2) SELECT item_id, doc_id, round(CAST(n AS DOUBLE) / (na + nb - n), 6) AS jaccard FROM j JOIN (SELECT doc_id, count(*) AS na FROM s GROUP BY 1) USING (doc_id) JOIN (SELECT item_id, count(*) AS nb FROM b GROUP BY 1) USING (item_id)""")
def reuse_jaccard(spark, sf_dir):
    """Similarity of shingle sets of every item and document that share one."""
    from .texts import shingle_reuse

    def sizes(name, key, out):
        words = F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))
        n = F.size(F.array_distinct(text.ngrams(words, 5)))
        return table(spark, sf_dir, name).select(F.col(key).alias(f"_{key}"), n.alias(out))

    both = shingle_reuse(spark, sf_dir).join(sizes("documents", "doc_id", "na"), F.col("doc_id") == F.col("_doc_id")).join(sizes("benchmark", "item_id", "nb"), F.col("item_id") == F.col("_item_id"))
    return both.select("item_id", "doc_id", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("jaccard"))


_TYPED = "CASE client_id % 4 WHEN 0 THEN city WHEN 1 THEN substr(city, 1, k - 1) || substr(city, k + 1) WHEN 2 THEN substr(city, 1, k - 1) || 'x' || substr(city, k + 1) ELSE substr(city, 1, k - 1) || 'x' || substr(city, k) END"


@query(f"SELECT t.token, e.entry, levenshtein(t.token, e.entry) AS distance FROM (SELECT DISTINCT {_TYPED} AS token FROM (SELECT client_id, regexp_replace(city, '[^ -~]', '_', 'g') AS city, client_id % length(city) + 1 AS k FROM clients WHERE city IS NOT NULL)) t JOIN (SELECT DISTINCT regexp_replace(city, '[^ -~]', '_', 'g') AS entry FROM clients) e ON levenshtein(t.token, e.entry) <= 1")
def gazetteer_fuzzy(spark, sf_dir):
    """Entries at most one edit away, anywhere in the word; tokens are names with a letter lost, changed or added.  Letters
    beyond ASCII are one sign here, as the SQL measures bytes."""
    c = table(spark, sf_dir, "clients").where("city IS NOT NULL").select("client_id", F.regexp_replace("city", "[^ -~]", "_").alias("city")).withColumn("k", F.expr("CAST(client_id % length(city) + 1 AS INT)"))
    near = gazetteer.fuzzy(c.select(F.expr(_TYPED).alias("token")), c, "token", "city")
    return near.select("token", "entry", F.col("distance").cast("long").alias("distance"))


@query("""WITH w AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(text, '[^ \\n]+')) AS word FROM documents WHERE lang IS NOT NULL) GROUP BY 1, 2), t AS (SELECT lang, sum(n) AS t FROM w GROUP BY 1), top AS (SELECT word FROM w GROUP BY word ORDER BY sum(n) DESC, word LIMIT 30),
f AS (SELECT t.lang, top.word, coalesce(n, 0) / CAST(t AS DOUBLE) AS f FROM t JOIN top ON true LEFT JOIN w ON w.lang = t.lang AND w.word = top.word) SELECT a.lang AS a, b.lang AS b, round(sum(abs(a.f - b.f)), 6) AS distance FROM f a JOIN f b ON a.word = b.word AND a.lang < b.lang GROUP BY 1, 2""")
def style_distance(spark, sf_dir):
    """How far the languages' use of the 30 most frequent words is apart."""
    words = table(spark, sf_dir, "documents").where("lang IS NOT NULL").select("lang", F.explode(F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))).alias("word"))
    counts = shared.written(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "counts")
    top = counts.groupBy("word").agg(F.sum("n").alias("m")).orderBy(F.desc("m"), "word").limit(30).select("word")
    total = counts.groupBy("lang").agg(F.sum("n").alias("t"))
    used = counts.join(F.broadcast(top), "word").join(total, "lang").select("word", "lang", (F.col("n") / F.col("t")).alias("f"))  # 30 rows
    per_word = used.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "f"))).alias("f"))  # an entry a language
    names = total.agg(F.sort_array(F.collect_set("lang")).alias("names"))
    pairs = per_word.join(F.broadcast(names)).select("f", F.explode("names").alias("a"), "names").select("f", "a", F.explode("names").alias("b")).where("a < b")  # one row of names
    share = lambda c: F.coalesce(F.try_element_at("f", F.col(c)), F.lit(0.0))
    return pairs.groupBy("a", "b").agg(F.round(F.sum(F.abs(share("a") - share("b"))), 6).alias("distance"))


@query("SELECT o_orderkey, l.c_name AS \"left\", r.s_name AS \"right\" FROM orders LEFT JOIN customer l ON c_custkey = o_custkey LEFT JOIN supplier r ON s_suppkey = o_orderkey % 20 ORDER BY o_orderkey LIMIT 5")
def join_listing(spark, sf_dir):
    """The first five statements with both ends; the five are the feature."""
    left = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("left"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("right"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.join(left, F.col("o_custkey") == F.col("c_custkey"), "left").join(right, F.col("s_suppkey") == F.col("o_orderkey") % 20, "left").select("o_orderkey", "left", "right").orderBy("o_orderkey").limit(5)


@query("SELECT l_orderkey, max(l_linenumber) AS last_sign, string_agg(CAST(l_partkey AS VARCHAR) || ':' || l_returnflag, ' | ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS candidates FROM lineitem GROUP BY l_orderkey")
def interlinear(spark, sf_dir):
    """All candidates of a word in index order, shown at its last sign."""
    shown = F.concat(F.col("l_partkey").cast("string"), F.lit(":"), F.col("l_returnflag"))
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", shown.alias("s"))))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("last_sign"), F.array_join(F.transform(ordered, lambda x: x["s"]), " | ").alias("candidates"))


@query("SELECT * FROM (VALUES ('plain', 'text', 'ok'), ('plain', 'lang', 'ok'), ('plain', 'colour', 'missing'), ('link', 'url', 'ok'), ('plain', 'none', 'empty')) v(format, feature, fault)")
def display_check(spark, sf_dir):
    tables = {"document": table(spark, sf_dir, "documents").withColumn("none", F.lit(None).cast("string")), "page": table(spark, sf_dir, "pages")}
    return render.display_faults(tables, {"plain": ("document", "{text}{lang/colour}{none}"), "link": ("page", "<{url}>")})


@query(f"SELECT 'documents' AS name, CAST(count(*) AS DOUBLE) AS value FROM documents UNION ALL SELECT 'words', count(*) FROM ({_WORDS}) UNION ALL SELECT 'repeated texts', count(*) FROM (SELECT sha256(text) FROM documents GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'most analyses', max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) UNION ALL SELECT 'documents with digits', count(*) FROM documents WHERE regexp_matches(text, '[0-9]')")
def mini_statistics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = {
        "documents": docs.agg(F.count("*").alias("v")),
        "words": _words(spark, sf_dir).agg(F.count("*").alias("v")),
        "repeated texts": docs.groupBy(F.sha2("text", 256)).count().where("count > 1").agg(F.count("*").alias("v")),
        "most analyses": table(spark, sf_dir, "lineitem").groupBy("l_orderkey").count().agg(F.max("count").alias("v")),
        "documents with digits": docs.where(F.col("text").rlike("[0-9]")).agg(F.count("*").alias("v")),
    }
    parts = [df.select(F.lit(n).alias("name"), F.col("v").cast("double").alias("value")) for n, df in rows.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS month, strftime(o_orderdate + INTERVAL 45 DAY, '%Y-%m-%d') AS due, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS cents, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 2020 END AS opaque_year FROM orders")
def dates_and_decimals(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    opaque = F.when(F.col("o_orderkey") % 2 == 0, "um 2020").otherwise("2020-02-03")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(F.trunc(day, "month"), "yyyy-MM-dd").alias("month"), F.date_format(F.date_add(day, 45), "yyyy-MM-dd").alias("due"), F.round(F.col("o_totalprice").cast("decimal(18,4)") * 100, 0).cast("long").cast("string").alias("cents"), F.year(F.try_to_timestamp(opaque, F.lit("yyyy-MM-dd"))).alias("opaque_year"))


@query("SELECT doc_id, lang, n_chars, source FROM documents")
def module_load(spark, sf_dir):
    """Two modules of one table; the optional one is joined because a wanted column lies in it."""
    main, optional = corpus.split_modules(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id", ["source", "n_chars"])
    return corpus.load_modules(main, [optional], "doc_id", ["doc_id", "lang", "n_chars", "source"])


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def report_sink(spark, sf_dir):
    """A report written as packed JSON lines and read back."""
    path = shared.folder(spark, "report")
    table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")).write.option("compression", "gzip").json(path)
    return spark.read.schema("lang string, n long").json(path)


def _files(spark, sf_dir):
    k = F.col("page_id")
    path = F.concat(F.lit("CTH "), (k % 9).cast("string"), F.lit("_XML_P"), (k % 3).cast("string"), F.lit("/s"), (k % 4).cast("string"), F.lit("/"), k.cast("string"), F.lit(".xml"))
    body = F.concat(F.lit("<a><docID>K "), (k % 20).cast("string"), F.lit("</docID></a>"))
    return table(spark, sf_dir, "pages").select(path.alias("src_file"), F.encode(body, "utf-8").alias("content"), F.octet_length(body).cast("long").alias("size"))


@query("SELECT 'r1' AS release, 'CTH ' || CAST(k % 9 AS VARCHAR) || '_XML_P' || CAST(k % 3 AS VARCHAR) || '/s' || CAST(k % 4 AS VARCHAR) || '/' || CAST(k AS VARCHAR) || '.xml' AS rel, 'CTH ' || CAST(k % 9 AS VARCHAR) || '_XML_P' || CAST(k % 3 AS VARCHAR) AS top_dir, CAST(k % 9 AS VARCHAR) AS cth, 'P' || CAST(k % 3 AS VARCHAR) AS project, CAST(k AS VARCHAR) AS stem, 'K ' || CAST(k % 20 AS VARCHAR) AS docid, sha256('<a><docID>K ' || CAST(k % 20 AS VARCHAR) || '</docID></a>') AS sha256 FROM (SELECT page_id AS k FROM pages)")
def release_records(spark, sf_dir):
    return corpus.releases(_files(spark, sf_dir), "r1")


@query("SELECT dir, count(*) AS files, CAST(sum(length('<a><docID>K ' || CAST(k % 20 AS VARCHAR) || '</docID></a>')) AS BIGINT) AS bytes FROM (SELECT page_id AS k, unnest(['CTH ' || CAST(page_id % 9 AS VARCHAR) || '_XML_P' || CAST(page_id % 3 AS VARCHAR), 'CTH ' || CAST(page_id % 9 AS VARCHAR) || '_XML_P' || CAST(page_id % 3 AS VARCHAR) || '/s' || CAST(page_id % 4 AS VARCHAR)]) AS dir FROM pages) GROUP BY dir")
def directory_inventory(spark, sf_dir):
    return corpus.directories(_files(spark, sf_dir))


@query("SELECT c_custkey, 1 AS ord, 'annot' AS kind, '2020' AS date FROM customer UNION ALL SELECT c_custkey, 3, 'validation', c_mktsegment FROM customer")
def edits_extraction(spark, sf_dir):
    """Edit events of a header; their order counts all of the header's elements, not only those kept."""
    xml = F.concat(F.lit('<d><meta><annot date="2020"/><other/><validation date="'), "c_mktsegment", F.lit('"/><annot/></meta><annot date="x"/></d>'))
    spans = shared.written(markup.spans(table(spark, sf_dir, "customer").select("c_custkey", xml.alias("xml")), "c_custkey", "xml").select("key", "tag", "ord", "outer_start", "inner_start", "inner_end", F.col("attrs")["date"].alias("date")), "spans")
    head = spans.where("tag = 'meta'").select(F.col("key").alias("_k"), F.col("ord").alias("_o"), F.col("inner_start").alias("_a"), F.col("inner_end").alias("_b"))
    inside = spans.join(head, (F.col("key") == F.col("_k")) & (F.col("outer_start") >= F.col("_a")) & (F.col("outer_start") < F.col("_b")))
    return inside.where("tag IN ('annot', 'validation') AND date IS NOT NULL").select(F.col("key").alias("c_custkey"), (F.col("ord") - F.col("_o")).alias("ord"), F.col("tag").alias("kind"), "date")
