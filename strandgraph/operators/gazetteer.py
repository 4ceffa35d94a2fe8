"""Words near the entries of a list, by edit distance, without comparing all pairs.

Two words within ``most`` edits share a string that is left when at most ``most`` letters are taken out of each, so the
neighbourhoods under deletion are an equality join; what meets is then measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deletions(word: Column, most: int) -> Column:
    """The word and all strings left when 1 to ``most`` letters are taken out; about length to the ``most`` of them."""
    found = F.array(word)
    for _ in range(most):
        less = F.transform(found, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))
        found = F.array_distinct(F.concat(found, F.flatten(less)))
    return found


def fuzzy(tokens: DataFrame, entries: DataFrame, token: str, entry: str, most: int = 1) -> DataFrame:
    """token, entry, distance of all pairs at most ``most`` edits apart, exact ones too; nulls are near nothing."""
    a = tokens.select(F.col(token).alias("token")).where("token IS NOT NULL").distinct()
    b = entries.select(F.col(entry).alias("entry")).where("entry IS NOT NULL").distinct()
    left = a.select("token", F.explode(deletions(F.col("token"), most)).alias("_k"))
    right = b.select("entry", F.explode(deletions(F.col("entry"), most)).alias("_l"))
    met = left.join(right, F.col("_k") == F.col("_l")).select("token", "entry").distinct()
    return met.withColumn("distance", F.levenshtein("token", "entry", most)).where("distance >= 0")
