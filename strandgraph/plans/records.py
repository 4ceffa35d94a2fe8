"""Queries over feature files, offset maps and byte spans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import markup, offsets
from ..sources import features, shared, signlists
from ..sources.tables import table
from .registry import query


def _langs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("node"), F.col("lang").alias("value"))


@query("""WITH v AS (SELECT DISTINCT doc_id AS node, lang AS value, CAST(floor(doc_id / 65536) AS BIGINT) AS part FROM documents WHERE lang IS NOT NULL),
g AS (SELECT *, node - row_number() OVER (PARTITION BY part, value ORDER BY node) AS g FROM v),
i AS (SELECT part, value, min(node) AS lo, max(node) AS hi FROM g GROUP BY part, value, g)
SELECT part, min(lo) AS first, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) || chr(9) || value AS line FROM i GROUP BY part, value""")
def feature_compact(spark, sf_dir):
    return features.compact(_langs(spark, sf_dir))


@query("SELECT doc_id AS node, lang AS value FROM documents WHERE lang IS NOT NULL")
def feature_roundtrip(spark, sf_dir):
    written = features.files(features.compact(_langs(spark, sf_dir)), {"node": "", "valueType": "str"})
    return features.read_nodes(written).select("node", "value")


@query("""WITH l AS (SELECT doc_id, len(a) AS n, unnest(range(0, len(a))) AS line, unnest(a) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
p AS (SELECT *, CAST(coalesce(sum(length(s) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS original FROM l)
SELECT doc_id, CAST(line AS BIGINT) AS line, original, original + 2 * CAST(line AS BIGINT) AS moved, NOT (length(s) = 0 AND line < n - 1) AS exact FROM p""")
def offset_map(spark, sf_dir):
    """Where each line begins once every line end is written as three characters."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    before = Window.partitionBy("doc_id").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.select("doc_id", F.col("line").cast("long").alias("line"), F.coalesce(F.sum(F.length("s") + 1).over(before), F.lit(0)).cast("long").alias("original"))
    edits = starts.where("line > 0").select("doc_id", (F.col("original") - 1).alias("start"), F.col("original").alias("end"), F.lit(3).alias("new_len"))
    return offsets.translate(starts, offsets.pieces(edits, "doc_id"), "doc_id", "original")


@query("""WITH l AS (SELECT doc_id, unnest(range(0, len(a))) AS line, unnest(a) AS s FROM (SELECT doc_id, string_split(replace(replace(text, '&', '&amp;'), '<', '&lt;'), chr(10)) AS a FROM documents)),
b AS (SELECT doc_id, line, strlen(s) AS n, 12 + length(CAST(doc_id AS VARCHAR)) AS head FROM l),
p AS (SELECT *, head + coalesce(sum(n + 7) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM b)
SELECT doc_id, CAST(line + 1 AS INTEGER) AS ord, 'l' AS tag, 1 AS depth, CAST(s AS BIGINT) AS outer_start, CAST(s + n + 7 AS BIGINT) AS outer_end, CAST(s + 3 AS BIGINT) AS inner_start, CAST(s + 3 + n AS BIGINT) AS inner_end FROM p
UNION ALL SELECT doc_id, 0, 'text', 0, 0, CAST(min(head) + sum(n + 7) + 7 AS BIGINT), min(head), CAST(min(head) + sum(n + 7) AS BIGINT) FROM b GROUP BY doc_id""")
def span_scan(spark, sf_dir):
    """The elements of each document as XML, a line an element."""
    safe = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(F.lit('<text id="'), F.col("doc_id").cast("string"), F.lit('"><l>'), F.replace(safe, F.lit("\n"), F.lit("</l><l>")), F.lit("</l></text>"))
    texts = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", xml.alias("xml"))
    return markup.spans(texts, "doc_id", "xml").select(F.col("key").alias("doc_id"), "ord", "tag", "depth", "outer_start", "outer_end", "inner_start", "inner_end")


@query("SELECT DISTINCT lower(p_brand) AS reading, CAST(p_size AS VARCHAR) AS sign, 'parts' AS source FROM part WHERE p_partkey % 5 > 0 AND p_size IS NOT NULL AND p_brand <> ''")
def sign_list(spark, sf_dir):
    """A list of readings and signs, written as text and read as such lists are; a fifth of the readings name a measure."""
    reading = F.concat("p_brand", F.when(F.col("p_partkey") % 5 == 0, "(x)").otherwise(""))
    path = shared.folder(spark, "signs")
    table(spark, sf_dir, "part").select(F.concat(reading, F.lit("\t"), F.col("p_size").cast("string")).alias("value")).where("value IS NOT NULL").write.text(path)
    return signlists.tab_pairs(spark, path, "parts", spelling=F.lower)
