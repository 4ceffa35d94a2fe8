"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annulus, cotrain, decontam, forest, html_crf, language_id, minhash, mixing, quality_rules, reverse_merge, secret_scan, token_store, warc
from .common import table

#: Production tokenizer of the token store and the id that ends a document.
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]
    named = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("key").alias("doc_id"), *[count(k) for k in base], F.sha2(named(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select(F.col("key").alias("doc_id"), language_id.held_out(F.col("key")).alias("held_out"), "lang_pred", "score")


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(*(table(spark, sf_dir, name) for name in ("documents", "labels", "pages")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op10_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op12_reverse_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reverse_merge.versions(table(spark, sf_dir, "client_changes"))


def op13_annulus_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annulus.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_rules, op2_secret_scan, op3_warc_salvage, op4_html_crf, op5_token_store, op6_language_id, op7_cotraining, op8_decontamination, op9_minhash_dedup, op10_pfair_mix, op11_forest_neighbours, op12_reverse_merge, op13_annulus_clusters)}

def _clusters_sql(rounds: int) -> str:
    """Rounds of assignment to all centroids, and of floored means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS m FROM (
  SELECT r, c, CAST(list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM kept, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(moved.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS v FROM (
    SELECT m.c AS c, k, sum(v[k]) AS s, count(*) AS n FROM kept JOIN a{i} USING (r), range(1, 65) AS t(k) GROUP BY 1, 2) GROUP BY c) AS moved ON moved.c = c{i}.c)""")
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS c, v FROM kept QUALIFY c < 16),
{", ".join(steps)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256 FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.c = m.c"""


ORACLE: dict[str, str] = {
    "op3_warc_salvage": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS head FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to FROM r""",
    "op8_decontamination": """
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
ws AS (SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM low),
lowb AS (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
bw AS (SELECT item_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowb),
items AS (SELECT item_id, w, least(10, len(w)) AS n FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM ws, sizes WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM pos p JOIN win ON win.n = p.n AND win.g = array_to_string(p.w[p.i : p.i + p.n - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT ws.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM ws LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_reverse_merge": """
WITH bits AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, r: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) AS b(i))),
crcs AS (SELECT change_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(change_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT change_id FROM client_changes WHERE change_id IS NOT NULL), bits),
r AS (SELECT DISTINCT change_id, client_id, seq, op, valid_at - CASE WHEN crc % 3 = 0 THEN INTERVAL 240 HOUR ELSE INTERVAL 0 HOUR END AS ts, source, segment, city,
    CASE WHEN isfinite(balance) AND abs(balance) < 9e16 THEN CAST(floor(100 * balance + 0.5) AS BIGINT) END AS cents
  FROM client_changes LEFT JOIN crcs USING (change_id) WHERE valid_at IS NOT NULL),
one AS (SELECT * FROM r WHERE op IN ('D', 'I', 'U') QUALIFY row_number() OVER (PARTITION BY client_id, seq ORDER BY change_id DESC NULLS LAST, ts DESC) = 1),
two AS (SELECT *, op = 'D' AS dead FROM one QUALIFY row_number() OVER (PARTITION BY client_id, ts ORDER BY seq DESC NULLS LAST) = 1),
part AS (SELECT client_id, ts, seq, dead, CASE WHEN NOT dead THEN source END AS source, CASE WHEN NOT dead THEN segment END AS segment, CASE WHEN NOT dead THEN city END AS city, CASE WHEN NOT dead THEN cents END AS cents,
    sum(CASE WHEN op = 'U' THEN 0 ELSE 1 END) OVER (PARTITION BY client_id ORDER BY ts) AS g FROM two),
state AS (SELECT client_id, ts, seq, dead, last_value(source IGNORE NULLS) OVER w AS source, last_value(segment IGNORE NULLS) OVER w AS segment, last_value(city IGNORE NULLS) OVER w AS city, last_value(cents IGNORE NULLS) OVER w AS cents
  FROM part WINDOW w AS (PARTITION BY client_id, g ORDER BY ts ROWS UNBOUNDED PRECEDING)),
opening AS (SELECT * FROM (SELECT *, {'d': dead, 's': source, 'g': segment, 'c': city, 'b': cents} AS now, lag({'d': dead, 's': source, 'g': segment, 'c': city, 'b': cents}) OVER (PARTITION BY client_id ORDER BY ts) AS before,
    row_number() OVER (PARTITION BY client_id ORDER BY ts) AS k FROM state) WHERE k = 1 OR now IS DISTINCT FROM before),
v AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ts) AS version, lead(ts) OVER (PARTITION BY client_id ORDER BY ts) AS till FROM opening),
n AS (SELECT v.client_id, v.version, count(DISTINCT r.change_id) AS n_changes FROM r JOIN v ON r.client_id IS NOT DISTINCT FROM v.client_id AND r.ts >= v.ts AND (v.till IS NULL OR r.ts < v.till) GROUP BY 1, 2)
SELECT v.client_id, CAST(v.version AS INTEGER) AS version, CAST(floor(epoch(ts)) AS BIGINT) AS valid_from, CAST(floor(epoch(till)) AS BIGINT) AS valid_to, dead AS is_deleted,
  source, segment, city, cents AS balance_cents, seq AS first_seq, coalesce(n_changes, 0) AS n_changes
FROM v LEFT JOIN n ON n.client_id IS NOT DISTINCT FROM v.client_id AND n.version = v.version""",
    "op13_annulus_clusters": _clusters_sql(3),
}
