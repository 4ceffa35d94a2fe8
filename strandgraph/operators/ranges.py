"""Ordered ranges: pairing of open and close marks, coverage, flags, islands and interval joins.

Every join carries an equality key, so it plans as a sort-merge join with a residual predicate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .buckets import meeting, within
from .ordered import running_sum


def pair_ranges(marks: DataFrame, by: list[str], line: str, order: list[str], opens: Column) -> DataFrame:
    """Pairs marks without a stack: an open mark is closed by the next mark of its family on the same line if that
    closes; otherwise it is an orphan.  Each row is one range: paired, open or close.

    A range crosses a line's end only if the next line begins with the matching close."""
    w = Window.partitionBy(*by).orderBy(*order)
    m = marks.withColumn("_open", opens)
    m = m.select("*", F.lead("_open").over(w).alias("_next"), F.lag("_open").over(w).alias("_last"), F.lead(line).over(w).alias("_next_line"), F.lag(line).over(w).alias("_last_line"))
    first = F.row_number().over(Window.partitionBy(*by, line).orderBy(*order)) == 1
    m = m.withColumn("_first", first)
    m = m.withColumn("_next_first", F.lead("_first").over(w))
    closed = (F.col("_next") == F.lit(False)) & ((F.col("_next_line") == F.col(line)) | F.col("_next_first"))
    taken = (F.col("_last") == F.lit(True)) & ((F.col("_last_line") == F.col(line)) | F.col("_first"))
    state = F.when(F.col("_open") & closed, "paired").when(F.col("_open"), "open").when(~F.coalesce(taken, F.lit(False)), "close")
    return m.withColumn("state", state).where("state IS NOT NULL").withColumn("crosses", (F.col("state") == "paired") & (F.col("_next_line") != F.col(line)))


def coverage(lo: Column, hi: Column, drop_lo: Column, drop_hi: Column) -> tuple[Column, Column, Column]:
    """First and last covered slot and width of a range whose boundary signs may fall outside it; no slot is listed."""
    a, b = F.least(lo, hi), F.greatest(lo, hi)
    a2 = a + F.when(drop_lo & (lo == a) | drop_hi & (hi == a), 1).otherwise(0)
    b2 = b - F.when(drop_lo & (lo == b) | drop_hi & (hi == b), 1).otherwise(0)
    return a2, b2, F.greatest(F.lit(0), b2 - a2 + 1)


def open_coverage(spans: DataFrame, slots: DataFrame, by: str, strict: bool = False) -> DataFrame:
    """Adds lo, hi (null if nothing is covered), width and anchor to ranges whose ends may be unknown.

    ``spans`` has start_sign, start_offset, end_sign, end_offset (null signs lie outside every sign) and orphan (none,
    open or close); ``slots`` has slot and length, contiguous in each ``by``.  An unknown start is the first slot, an
    unknown end the last; swapped ends are put in order.  A start behind its sign's last letter and an end before its
    sign's first leave that sign out; inside one sign a range covers it only if it has an extent.  A range that covers
    nothing has width 0 and an anchor: its start, its end, or the first slot; one whose anchor is no slot is left out.
    ``strict``: an orphan close without a sign before it covers nothing, instead of all up to its end."""
    edges = slots.groupBy(F.col(by).alias("_d")).agg(F.min("slot").alias("_first"), F.max("slot").alias("_last"))
    length = slots.select(F.col(by).alias("_e"), F.col("slot").alias("_slot"), "length")
    both = spans.join(edges, F.col(by) == F.col("_d")).join(length, (F.col(by) == F.col("_e")) & (F.col("start_sign") == F.col("_slot")), "left")
    start, end = F.col("start_sign"), F.col("end_sign")
    a, b = F.coalesce(start, "_first"), F.coalesce(end, "_last")
    both = both.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b))
    lo, hi = F.col("_lo"), F.col("_hi")
    behind = start.isNotNull() & (F.col("start_offset") >= F.coalesce("length", F.lit(0)))
    before = end.isNotNull() & (F.col("end_offset") <= 0)
    inside = (lo == hi) & start.eqNullSafe(end)
    drops = lambda at: F.when(behind & start.eqNullSafe(at) | before & end.eqNullSafe(at), 1).otherwise(0)
    empty = F.when(inside, F.col("start_offset") >= F.col("end_offset")).when(lo == hi, drops(lo) > 0).otherwise(lo + drops(lo) > hi - drops(hi))
    if strict:
        empty = empty | (F.col("orphan") == "close") & start.isNull()
    new_lo, new_hi = F.when(~empty, F.when(inside, lo).otherwise(lo + drops(lo))), F.when(~empty, F.when(inside, hi).otherwise(hi - drops(hi)))
    anchor = F.when(empty, F.coalesce(start, end, "_first"))
    held = both.where(~empty | F.coalesce(start, end, "_first").between(F.col("_first"), F.col("_last")))
    return held.select(*spans.columns, new_lo.alias("lo"), new_hi.alias("hi"), F.coalesce(new_hi - new_lo + 1, F.lit(0)).cast("long").alias("width"), anchor.alias("anchor"))


def active_counts(ranges: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """by, point, active: a sweep over +1 at lo and -1 after hi; no point inside a range is listed, no task holds a group."""
    steps = ranges.select(*by, F.col(lo).alias("point"), F.lit(1).alias("d")).unionByName(ranges.select(*by, (F.col(hi) + 1).alias("point"), F.lit(-1).alias("d")))
    steps = steps.groupBy(*by, "point").agg(F.sum("d").alias("d"))
    return running_sum(steps, by, ["point"], "d", "active").select(*by, "point", "active")


def islands(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, lo, hi, n: maximal runs of consecutive values."""
    w = Window.partitionBy(*by).orderBy(value)
    tagged = rows.select(*by, value).distinct().withColumn("_g", F.col(value) - F.row_number().over(w))
    return tagged.groupBy(*by, "_g").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n")).drop("_g")


def union_ranges(ranges: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """Overlapping or touching ranges joined."""
    before = Window.partitionBy(*by).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    start = F.when(F.col(lo) <= F.max(hi).over(before) + 1, 0).otherwise(1)
    w = Window.partitionBy(*by).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, 0)
    tagged = ranges.withColumn("_s", start).withColumn("_g", F.sum("_s").over(w))
    return tagged.groupBy(*by, "_g").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.count("*").alias("n")).drop("_g")


def nested(ranges: DataFrame, by: list[str], lo: str, hi: str, key: str) -> DataFrame:
    """Adds ``nested``: the range lies inside one that starts no later (running maximum, no self join)."""
    before = Window.partitionBy(*by).orderBy(F.col(lo), F.col(hi).desc(), F.col(key)).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("nested", F.coalesce(F.max(hi).over(before) >= F.col(hi), F.lit(False)))


def contained(outer: DataFrame, inner: DataFrame, key: str) -> DataFrame:
    """Pairs of an outer (lo, hi) with an inner (p_lo, p_hi) extent inside it; anchors aren't extents."""
    return within(outer, inner, key)


def overlapping(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Pairs of (lo, hi) and (p_lo, p_hi) that share a point."""
    return meeting(a, b, key)


def sessions(events: DataFrame, by: str, at: str, order: list[str], gap: int) -> DataFrame:
    """Adds ``session``: a new one begins after more than ``gap``."""
    w = Window.partitionBy(by).orderBy(*order)
    new = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    return events.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def fill_forward(value: Column, by: list[str], order: list[str]) -> Column:
    """The latest non-null value so far.  Wrap in a struct to let a null reset the scope."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def anchor(value: Column, by: list[str], order: list[str]) -> Column:
    """The latest earlier value, or else the next later one."""
    w = Window.partitionBy(*by).orderBy(*order)
    return F.coalesce(F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
