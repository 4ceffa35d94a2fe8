"""Containers from the order of events: surfaces, columns, lines, paragraphs, colons, and the language in force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(changes: Column, by: list[str], order: list[str]) -> Column:
    """How many changes there have been so far: the number of the running container."""
    return F.sum(changes.cast("int")).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def differs(value: Column, by: list[str], order: list[str]) -> Column:
    """Whether the value isn't that of the row before; a first row differs."""
    w = Window.partitionBy(*by).orderBy(*order)
    return (F.row_number().over(w) == 1) | ~value.eqNullSafe(F.lag(value).over(w))


def containers(lines: DataFrame, by: list[str], order: list[str], label: str, ruling: str, colon: str) -> DataFrame:
    """Adds column_no, paragraph_no and colon_no to lines in order.

    A column begins where the label changes, and ends the paragraph and the colon; a paragraph begins with the line
    after a ruling; a colon begins at a line that has a colon mark, and lines before the first have none."""
    seen = lines.withColumn("_c", differs(F.col(label), by, order))
    after = F.coalesce(F.lag(F.col(ruling).isNotNull()).over(Window.partitionBy(*by).orderBy(*order)), F.lit(False))
    seen = seen.withColumn("column_no", numbered(F.col("_c"), by, order)).withColumn("_p", F.col("_c") | after)
    seen = seen.withColumn("paragraph_no", numbered(F.col("_p"), by, order))
    mark = F.when(F.col(colon).isNotNull() | F.col("_c"), F.struct(F.when(F.col(colon).isNotNull(), numbered(F.col(colon).isNotNull(), by, order)).alias("n")))
    running = F.last(mark, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return seen.withColumn("_m", mark).withColumn("colon_no", running["n"]).drop("_c", "_p", "_m")


def extents(rows: DataFrame, keys: list[str], slot: str) -> DataFrame:
    """keys, first_slot, last_slot, n."""
    return rows.groupBy(*keys).agg(F.min(slot).alias("first_slot"), F.max(slot).alias("last_slot"), F.count("*").alias("n"))


def language(word: Column, colon: Column, line: Column, text: Column, unset: tuple[str, ...] = ("", "XXXlang")) -> Column:
    """The language of a word: its own, else the active colon's, the line's, the text's; ``unset`` values count as none."""
    return F.coalesce(*[F.when(~c.isin(*unset), c) for c in (word, colon, line, text)])


def active(event: Column, value: Column, by: list[str], order: list[str]) -> Column:
    """The value of the latest event, null also where that event's own value is null."""
    held = F.when(event, F.struct(value.alias("v")))
    return F.last(held, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))["v"]


def anchors(containers_: DataFrame, slots: DataFrame, key: str) -> DataFrame:
    """One artificial slot, of type empty, for each container that holds none."""
    empty = containers_.select(key).distinct().join(slots.select(key).distinct(), key, "left_anti")
    return empty.withColumn("type", F.lit("empty")).withColumn("anchor", F.lit(1))


def apparatus(tokens: DataFrame, by: list[str], order: str) -> DataFrame:
    """Join statements of an apparatus: each separator with the entries next to it.

    ``tokens`` has kind (entry, separator or barrier) and value.  Neighbours are looked for past other separators but
    not past a barrier; a statement without both is unresolved."""
    rows = tokens.withColumn("_block", numbered(F.col("kind") == "barrier", by, [order]))
    w = Window.partitionBy(*by, "_block").orderBy(order)
    entry = F.when(F.col("kind") == "entry", F.col("value"))
    found = rows.select(
        *by, order, "kind", "value", F.last(entry, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("left"), F.first(entry, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("right")
    )
    out = found.where("kind = 'separator'")
    return out.select(*by, order, F.col("value").alias("mark"), "left", "right", (F.col("left").isNotNull() & F.col("right").isNotNull()).alias("resolved"))


def fragment_extents(fragments: DataFrame, lines: DataFrame, key: str, anchor: str) -> DataFrame:
    """key, lo, hi: the slots of a fragment's lines, or its document's anchor where it has none."""
    held = lines.groupBy(F.col(key).alias("_k")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return fragments.join(held, F.col(key) == F.col("_k"), "left").select(key, F.coalesce("lo", anchor).alias("lo"), F.coalesce("hi", anchor).alias("hi"), F.col("lo").isNull().alias("anchored"))
