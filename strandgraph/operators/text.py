"""Lines, words and signs of a text, with ordinals that make the order data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import let


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line (from 1), content: the text cut at line ends, nothing dropped."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line", "content")).withColumn("line", F.col("line") + 1)


def words(rows: DataFrame, content: str, *keys: str) -> DataFrame:
    """keys, pos (from 1), word: stretches without a space."""
    return rows.select(*keys, F.posexplode(F.regexp_extract_all(F.col(content), F.lit("[^ ]+"), F.lit(0))).alias("pos", "word")).withColumn("pos", F.col("pos") + 1)


def concordance(rows: DataFrame, content: str, word: str, *keys: str) -> DataFrame:
    """keys, pos (from 1), prev, next: every place of ``word`` with its neighbours, null at the ends.  Each row is read
    by itself, so nothing is shuffled or sorted."""
    held = rows.select(*keys, F.regexp_extract_all(F.col(content), F.lit("[^ ]+"), F.lit(0)).alias("_w")).where(F.array_contains("_w", word))
    hits = held.select(*keys, "_w", F.posexplode("_w").alias("_p", "_word")).where(F.col("_word") == word)
    return hits.select(*keys, (F.col("_p") + 1).alias("pos"), F.get("_w", F.col("_p") - 1).alias("prev"), F.get("_w", F.col("_p") + 1).alias("next"))


def signs(rows: DataFrame, content: str, *keys: str) -> DataFrame:
    """keys, pos, sym, after: smallest units and the separators that follow each; separators at the beginning follow an
    empty unit, so all of them joined give the text again."""
    whole = F.transform(F.regexp_extract_all(F.col(content), F.lit("[^-. ]+[-. ]*|^[-. ]+"), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, "^[^-. ]*", 0).alias("sym"), F.regexp_extract(x, "[-. ]*$", 0).alias("after")))
    return rows.select(*keys, F.posexplode(whole).alias("pos", "s")).select(*keys, (F.col("pos") + 1).alias("pos"), "s.sym", "s.after")


def token_class(token: Column) -> Column:
    """numeral, then unknown, ellipsis, mark, capital; everything else is a reading."""
    return F.when(token.rlike("^[0-9]+$"), "numeral").when(token.rlike("^[xX]$"), "unknown").when(token.rlike("^\\.\\.\\.$"), "ellipsis").when(token.rlike("^[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+$"), "mark").when(token.rlike("^[A-Z]"), "capital").otherwise("reading")


def rebuild(line_rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The text from its lines, in line order."""
    ordered = F.array_sort(F.collect_list(F.struct("line", "content")))
    return line_rows.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["content"]), "\n").alias("text"))


def render(units: DataFrame, by: list[str], order: str, part: Column, separator: str = "") -> DataFrame:
    """The ordered concatenation of a container's units."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("p"))))
    return units.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda x: x["p"]), separator).alias("rendered"))


def ngrams(array: Column, n: int) -> Column:
    """All runs of n neighbours as space-joined strings; none if there are fewer."""

    def grams(a):
        return F.when(F.size(a) >= n, F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.array_join(F.slice(a, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return let(array, grams)
