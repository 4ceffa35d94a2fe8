"""Offsets across edits: a table of pieces takes positions from one version of a text to the other.

Edits (start, end, new_len) of a text don't overlap.  Positions meet pieces in a window, as an as-of join; no
position inside a piece is listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pieces(edits: DataFrame, by: str) -> DataFrame:
    """by, kind (copy or new), o_start, r_start, o_len, r_len; the last copy of a text has no length.  Texts without
    edits have no pieces."""
    w = Window.partitionBy(by).orderBy("start", "end")
    grown = F.col("new_len") - (F.col("end") - F.col("start"))
    at = F.col("start") + F.coalesce(F.sum(grown).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = edits.select(by, "start", "end", "new_len", at.alias("r"), F.lead("start").over(w).alias("next"), F.row_number().over(w).alias("n"))

    def piece(kind, o, r, o_len, r_len):
        return F.struct(F.lit(kind).alias("kind"), o.cast("long").alias("o_start"), r.cast("long").alias("r_start"), o_len.cast("long").alias("o_len"), r_len.cast("long").alias("r_len"))

    start, end, new, r, kept = F.col("start"), F.col("end"), F.col("new_len"), F.col("r"), F.col("next") - F.col("end")
    after = [piece("new", start, r, end - start, new), piece("copy", end, r + new, kept, kept)]
    first = piece("copy", F.lit(0), F.lit(0), start, start)
    spread = rows.select(by, F.explode(F.when(F.col("n") == 1, F.array(first, *after)).otherwise(F.array(*after))).alias("p"))
    return spread.select(by, "p.*")


def translate(points: DataFrame, table: DataFrame, by: str, point: str, to: str = "r") -> DataFrame:
    """Adds ``moved`` and ``exact`` to points of the original (to "r") or of the edited text (to "o").  A point
    inside an edit moves to its start and isn't exact; where there are no pieces nothing moves."""
    have = "o" if to == "r" else "r"
    held = table.where(F.coalesce(F.col(f"{have}_len"), F.lit(1)) > 0)
    marks = held.select(F.col(by), F.col(f"{have}_start").alias("_at"), F.lit(0).alias("_side"), F.struct("kind", "o_start", "r_start").alias("_piece"), F.lit(None).cast(points.select(F.struct(*points.columns)).schema[0].dataType).alias("_row"))
    asked = points.select(F.col(by), F.col(point).cast("long").alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(marks.schema["_piece"].dataType).alias("_piece"), F.struct(*points.columns).alias("_row"))
    w = Window.partitionBy(by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = marks.unionByName(asked).withColumn("_piece", F.last("_piece", ignorenulls=True).over(w)).where("_side = 1")
    inside = F.when(F.col("_piece.kind") == "copy", F.col("_at") - F.col(f"_piece.{have}_start")).otherwise(0)
    moved = F.when(F.col("_piece").isNull(), F.col("_at")).otherwise(F.col(f"_piece.{to}_start") + inside)
    return found.select("_row.*", moved.alias("moved"), F.coalesce(F.col("_piece.kind") == "copy", F.lit(True)).alias("exact"))
