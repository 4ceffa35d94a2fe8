"""Queries over texts: tokens, lexicon, rendering, reuse, parsing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import parsers
from ..operators import stats, text
from ..sources.tables import parts, table
from .registry import query

_LINES = "SELECT doc_id, CAST(i AS INTEGER) AS line, l[i] AS content FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"
_WORDS = f"SELECT doc_id, line, CAST(i AS INTEGER) AS pos, w[i] AS word FROM (SELECT doc_id, line, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, line, regexp_extract_all(content, '[^ ]+') AS w FROM ({_LINES})))"


def _words(spark, sf_dir):
    return text.words(text.lines(table(spark, sf_dir, "documents")), "content", "doc_id", "line")


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND n_chars > 1000")
def scan_project_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("lang = 'en' AND n_chars > 1000").select("doc_id", "source", "n_chars")


@query(f"SELECT doc_id, line, CAST(length(content) AS INTEGER) AS n_chars FROM ({_LINES})")
def line_tokens(spark, sf_dir):
    return text.lines(table(spark, sf_dir, "documents")).select("doc_id", "line", F.length("content").alias("n_chars"))


@query(_WORDS)
def word_tokens(spark, sf_dir):
    """Every word of each line."""
    return _words(spark, sf_dir)


@query("SELECT doc_id, count(*) AS n_signs, CAST(sum(CASE WHEN s LIKE '%-' OR s LIKE '%.' THEN 1 ELSE 0 END) AS BIGINT) AS n_marked FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^-. ]+[-. ]?')) AS s FROM documents) GROUP BY doc_id")
def sign_tokens(spark, sf_dir):
    s = text.signs(table(spark, sf_dir, "documents"), "text", "doc_id")
    return s.where("sym <> ''").groupBy("doc_id").agg(F.count("*").alias("n_signs"), F.sum(F.when(F.substring("after", 1, 1).isin("-", "."), 1).otherwise(0)).alias("n_marked"))


@query("SELECT doc_id, sha256(text) AS digest, CAST(length(text) AS INTEGER) AS n_chars FROM documents")
def token_roundtrip(spark, sf_dir):
    rebuilt = text.rebuild(text.lines(table(spark, sf_dir, "documents")))
    return rebuilt.select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").alias("n_chars"))


@query(f"""SELECT class, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(word, '^[0-9]+$') THEN 'numeral' WHEN regexp_matches(word, '^[xX]$') THEN 'unknown' WHEN word = '...' THEN 'ellipsis'
 WHEN regexp_matches(word, '^[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+$') THEN 'mark' WHEN regexp_matches(word, '^[A-Z]') THEN 'capital' ELSE 'reading' END AS class FROM ({_WORDS})) GROUP BY class""")
def token_type_class(spark, sf_dir):
    return _words(spark, sf_dir).groupBy(text.token_class(F.col("word")).alias("class")).agg(F.count("*").alias("n"))


@query("SELECT word, lang, count(*) AS noccs, min(doc_id) AS first_anchor FROM (SELECT doc_id, lang, unnest(regexp_extract_all(text, '[^ \\n]+')) AS word FROM documents) GROUP BY word, lang")
def lexicon(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select("doc_id", "lang", F.explode(F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))).alias("word"))
    return stats.lexicon(tokens, ["word", "lang"], "doc_id")


@query("SELECT sha256(text) AS docid, count(*) AS nrecords, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def docgroup(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("docid")).agg(F.count("*").alias("nrecords"), F.min("doc_id").alias("first_doc"))


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS rendered FROM conversations GROUP BY conv_id")
def text_render(spark, sf_dir):
    return text.render(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"), "\n")


@query("SELECT conv_id, turn, array_to_string(regexp_extract_all(text, '[^ ]+'), '_') AS rendered FROM conversations WHERE role = 'user'")
def text_render_line(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.array_join(F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0)), "_").alias("rendered"))


@query("SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id, turn) > 1 AS ambiguous FROM conversations WHERE turn = 1")
def section_lookup(spark, sf_dir):
    n = F.count("*").over(Window.partitionBy("conv_id", "turn"))
    return table(spark, sf_dir, "conversations").where("turn = 1").select("conv_id", "turn", "role", (n > 1).alias("ambiguous"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS ordinal, CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS address FROM conversations")
def section_of_node(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("ordinal"), F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("address"))


@query("SELECT conv_id, turn, CAST(i AS INTEGER) AS pos, len(w) - i AS from_end, w[i] AS token FROM (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT conv_id, turn, regexp_extract_all(text, '[^ ]+') AS w FROM conversations))")
def position_in_clause(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0)).alias("w"))
    return rows.select("conv_id", "turn", F.size("w").alias("n"), F.posexplode("w").alias("p", "token")).select("conv_id", "turn", (F.col("p") + 1).alias("pos"), (F.col("n") - F.col("p") - 1).cast("long").alias("from_end"), "token")


@query(f"SELECT doc_id, line, pos, prev, next FROM (SELECT *, lag(word) OVER w AS prev, lead(word) OVER w AS next FROM ({_WORDS}) WINDOW w AS (PARTITION BY doc_id, line ORDER BY pos)) WHERE word = 'the'")
def concordance(spark, sf_dir):
    return text.concordance(text.lines(table(spark, sf_dir, "documents")), "content", "the", "doc_id", "line")


@query("SELECT doc_id, CAST(i AS INTEGER) AS pos, array_to_string(w[greatest(1, i - 3) : i - 1], ' ') AS left_context, array_to_string(w[i + 1 : i + 3], ' ') AS right_context FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^ \\n]+') AS w FROM documents)) WHERE w[i] = 'und'")
def kwic(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0)).alias("w")).where(F.array_contains("w", "und"))
    hits = rows.select("doc_id", "w", F.explode(F.filter(F.transform("w", lambda x, i: F.when(x == "und", i + 1)), lambda p: p.isNotNull())).alias("pos"))
    left = F.when(F.col("pos") > 1, F.slice("w", F.greatest(F.lit(1), F.col("pos") - 3), F.col("pos") - F.greatest(F.lit(1), F.col("pos") - 3))).otherwise(F.array().cast("array<string>"))
    return hits.select("doc_id", "pos", F.array_join(left, " ").alias("left_context"), F.array_join(F.slice("w", F.col("pos") + 1, 3), " ").alias("right_context"))


@query(f"""WITH l AS (SELECT doc_id, line, list(word ORDER BY pos) AS ws FROM ({_WORDS}) GROUP BY doc_id, line),
x AS (SELECT ws, unnest(range(1, len(ws) + 1)) AS i FROM l), y AS (SELECT ws[i] AS a, unnest(ws[i + 1 : i + 4]) AS b FROM x),
p AS (SELECT a, b, count(*) AS n FROM y GROUP BY a, b HAVING count(*) >= 20), f AS (SELECT word AS w, count(*) AS f FROM ({_WORDS}) GROUP BY 1), t AS (SELECT sum(f) AS total FROM f)
SELECT a, b, n, round(log2(n * total / (fa.f * fb.f)), 6) AS pmi FROM p JOIN f fa ON fa.w = a JOIN f fb ON fb.w = b, t""")
def collocation(spark, sf_dir):
    rows = text.lines(table(spark, sf_dir, "documents")).select(F.regexp_extract_all("content", F.lit("[^ ]+"), F.lit(0)).alias("ws"))
    return stats.collocations(rows, 5, 20)


@query("""WITH s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^ \\n]+') AS w FROM documents))),
b AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT item_id, regexp_extract_all(text, '[^ \\n]+') AS w FROM benchmark)))
SELECT item_id, doc_id, count(*) AS shared FROM s JOIN b USING (g) GROUP BY item_id, doc_id""")
def shingle_reuse(spark, sf_dir):
    def shingles(name, key):
        words = F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))
        return table(spark, sf_dir, name).select(key, F.explode(text.ngrams(words, 5)).alias("g"))

    shared = shingles("documents", "doc_id").join(shingles("benchmark", "item_id").distinct(), "g").distinct()  # of what is shared only
    return shared.groupBy("item_id", "doc_id").agg(F.count("*").alias("shared"))


@query("SELECT a.p_partkey AS a, b.p_partkey AS b, levenshtein(a.p_name, b.p_name) AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey")
def edit_distance(spark, sf_dir):
    """Every pair is in the result, so the work grows with the square of a group; a group is cut into parts of about 256
    names, each of which meets the whole group, and the parts are dealt over all cores."""
    keys = ["p_brand", "p_size", "p_type"]
    part = table(spark, sf_dir, "part").select(*keys, "p_partkey", "p_name")
    placed = part.join(part.groupBy(*keys).agg(F.ceil(F.count("*") / 256).alias("parts")), keys)
    a = placed.select(*keys, F.col("p_partkey").alias("a"), F.col("p_name").alias("na"), F.pmod(F.xxhash64("p_partkey"), "parts").alias("part"))
    b = placed.select(*keys, F.col("p_partkey").alias("b"), F.col("p_name").alias("nb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    n = parts(part, 20_000)
    a, b = (x.repartition(n, *keys, "part") for x in (a, b))
    return a.join(b.hint("merge"), [*keys, "part"]).where("a < b").select("a", "b", F.levenshtein("na", "nb").cast("long").alias("distance"))


@query("SELECT d.doc_id, CAST(len(regexp_extract_all(text, '[^ \\n]+')) AS INTEGER) AS n_words, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines, round(CAST(length(text) AS DOUBLE) / greatest(1, len(regexp_extract_all(text, '[^ \\n]+'))), 6) AS chars_per_word, quality FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id")
def doc_features(spark, sf_dir):
    words = F.size(F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0)))
    rows = table(spark, sf_dir, "documents").select("doc_id", words.alias("n_words"), F.size(F.split("text", "\n")).alias("n_lines"), F.round(F.length("text").cast("double") / F.greatest(F.lit(1), words), 6).alias("chars_per_word"))
    return rows.join(table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id", "left")


@query("SELECT item_id, CAST(sum(n) AS BIGINT) AS n FROM (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^ \\n]+')) AS word FROM documents) GROUP BY word) d JOIN (SELECT DISTINCT item_id, unnest(regexp_extract_all(text, '[^ \\n]+')) AS word FROM benchmark) b USING (word) GROUP BY item_id")
def gazetteer_tag(spark, sf_dir):
    """Exact matches of words of any length."""

    def tokens(name, *keys):
        return table(spark, sf_dir, name).select(*keys, F.explode(F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))).alias("word"))

    counted = tokens("documents").groupBy("word").agg(F.count("*").alias("n"))  # before the join: one row a word
    return counted.join(tokens("benchmark", "item_id").distinct(), "word").groupBy("item_id").agg(F.sum("n").alias("n"))


@query("""WITH c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \\n]+')) AS term FROM documents) GROUP BY 1, 2), f AS (SELECT term, count(*) AS df FROM c GROUP BY 1), n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT doc_id, term, tf, round(tf * ln(CAST(n AS DOUBLE) / df), 6) AS weight FROM c JOIN f USING (term), n)
SELECT doc_id, term, tf, weight FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS r FROM w) WHERE r <= 3""")
def tfidf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = docs.select("doc_id", "text").repartition("doc_id").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    weighted = stats.tfidf(counts, "doc_id", "term", docs.agg(F.count("*").alias("n")), 3)
    return stats.top_k(weighted, ["doc_id"], [F.desc("weight"), F.asc("term")], 3).drop("rank")


@query("SELECT g, count(*) AS n FROM (SELECT substr(p_name, CAST(i AS BIGINT), 3) AS g FROM (SELECT p_name, unnest(range(1, length(p_name) - 1)) AS i FROM part)) GROUP BY g")
def char_ngrams(spark, sf_dir):
    grams = F.when(F.length("p_name") >= 3, F.transform(F.sequence(F.lit(1), F.length("p_name") - 2), lambda i: F.substring(F.col("p_name"), i, F.lit(3))))
    return table(spark, sf_dir, "part").select(F.explode(grams).alias("g")).groupBy("g").agg(F.count("*").alias("n"))


@query("""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) AS lang, regexp_extract(url, '/([0-9]+)(\\.html)?/?([?#].*)?$', 1) AS number,
 CASE WHEN regexp_extract(url, '^([a-z]+)://', 1) = '' THEN 'no_scheme' WHEN regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) = '' THEN 'no_lang' WHEN regexp_extract(url, '/([0-9]+)(\\.html)?/?([?#].*)?$', 1) = '' THEN 'no_number' ELSE 'ok' END AS outcome FROM pages""")
def path_grammar_parse(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", parsers.url_path(F.col("url")).alias("p")).select("page_id", "p.*")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'no_key' ELSE 'ok' END AS outcome FROM events")
def record_parse(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", k.cast("int").alias("k"), F.when(k.isNull(), "no_key").otherwise("ok").alias("outcome"))


@query("SELECT page_id, list_sort(regexp_extract_all(regexp_extract(url, '\\?([^#]*)', 1), '([a-z_]+)=', 1)) AS names FROM pages WHERE url LIKE '%?%'")
def selector_parse(spark, sf_dir):
    blob = F.regexp_extract("url", "\\?([^#]*)", 1)
    return table(spark, sf_dir, "pages").where(F.col("url").contains("?")).select("page_id", F.array_sort(F.regexp_extract_all(blob, F.lit("([a-z_]+)="), F.lit(1))).alias("names"))


@query("SELECT p_partkey, regexp_extract(p_name, '^([A-Za-z]+)', 1) AS head, regexp_extract(p_name, '([0-9]+)', 1) AS number, trim(regexp_replace(p_name, '^[A-Za-z]+', '')) AS tail FROM part")
def lineref_parse(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.regexp_extract("p_name", "^([A-Za-z]+)", 1).alias("head"), F.regexp_extract("p_name", "([0-9]+)", 1).alias("number"), F.trim(F.regexp_replace("p_name", "^[A-Za-z]+", "")).alias("tail"))


@query("""SELECT doc_id, CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS INTEGER) AS upper, CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS INTEGER) AS digits, CAST(length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) AS INTEGER) AS beyond_ascii, CAST(length(text) - length(replace(text, '%', '')) AS INTEGER) AS percents FROM documents""")
def codepoint_stats(spark, sf_dir):
    kept = lambda p: F.length(F.regexp_replace("text", p, ""))
    return table(spark, sf_dir, "documents").select("doc_id", kept("[^A-Z]").alias("upper"), kept("[^0-9]").alias("digits"), kept("[\\x00-\\x7F]").alias("beyond_ascii"), (F.length("text") - F.length(F.replace("text", F.lit("%"), F.lit("")))).alias("percents"))


@query("SELECT tag, count(*) AS n, count(DISTINCT page_id) AS pages FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages) GROUP BY tag")
def markup_tags(spark, sf_dir):
    tags = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))).alias("tag"))
    return tags.groupBy(F.lower("tag").alias("tag")).agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("pages"))


@query("SELECT name, value, count(*) AS n FROM (SELECT regexp_extract(a, '^([a-z]+)', 1) AS name, regexp_extract(a, '\"(.*)\"$', 1) AS value FROM (SELECT unnest(regexp_extract_all(html, '[a-z]+=\"[^\"]*\"')) AS a FROM pages)) GROUP BY name, value")
def markup_attr_map(spark, sf_dir):
    a = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit('[a-z]+="[^"]*"'), F.lit(0))).alias("a"))
    return a.select(F.regexp_extract("a", "^([a-z]+)", 1).alias("name"), F.regexp_extract("a", '"(.*)"$', 1).alias("value")).groupBy("name", "value").agg(F.count("*").alias("n"))


@query("SELECT page_id, md5(regexp_replace(html, '<[^>]*>', ' ', 'g')) AS digest FROM pages")
def markup_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(F.regexp_replace("html", "<[^>]*>", " ")).alias("digest"))
