"""Text formats, section addresses and checks of display templates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import let

_FIELD = re.compile(r"\{([^}]*)\}")


def compiled(fmt: str, column: Callable[[str], Column] = F.col) -> tuple[str | None, Column]:
    """The level and expression of a format such as ``line#{cu} ``: names in braces are columns (null: nothing), names
    parted by a slash the first that isn't null; before # stands the type that it is made for."""
    head, mark, body = fmt.partition("#")
    level, text = (head, body) if mark and re.fullmatch(r"\w+", head) else (None, fmt)
    parts, at = [], 0
    for m in _FIELD.finditer(text):
        if m.start() > at:
            parts.append(F.lit(text[at : m.start()]))
        parts.append(F.coalesce(*[column(n).cast("string") for n in m[1].split("/")], F.lit("")))
        at = m.end()
    if at < len(text) or not parts:
        parts.append(F.lit(text[at:]))
    return level, F.concat(*parts)


def fields(fmt: str) -> list[str]:
    return [n for m in _FIELD.finditer(fmt) for n in m[1].split("/")]


def rendered(units: dict[str | None, DataFrame], by: str, order: str, fmt: str) -> DataFrame:
    """by, rendered: a container's units in order; the format chooses the type of unit (None: the slots)."""
    level, part = compiled(fmt)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("p"))))
    return units[level].groupBy(by).agg(F.array_join(F.transform(ordered, lambda x: x["p"]), "").alias("rendered"))


def listed(rows: DataFrame, by: str, units: Column, line: str, order: str, unit: str, fmt: str) -> DataFrame:
    """by, line (from 1), rendered: the same for ``units`` that a row holds as lists of lines of units, without a row for
    each.  Lines of one number come together, their units by place; lines without units give no row."""
    part = lambda x: compiled(fmt, lambda n: x[n])[1]

    def whole(lists, i):
        placed = F.flatten(F.transform(lists, lambda u: F.coalesce(F.transform(F.get(u, i), lambda x, p: F.struct((p + 1).alias(order), x.alias(unit))), F.array())))
        return F.when(F.size(lists) > 1, F.array_sort(placed)).otherwise(placed)

    def lines(lists):
        n = F.array_max(F.transform(lists, F.size))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.transform(whole(lists, i), part), "")))

    return rows.select(by, F.posexplode(let(units, lines)).alias(line, "rendered")).where("rendered <> ''").withColumn(line, F.col(line) + 1)


def lookup(sections: DataFrame, wanted: DataFrame, levels: list[str], node: str) -> DataFrame:
    """The wanted addresses with a node for each match (null: none) and whether the address is ambiguous."""
    have = sections.select(*[F.col(c).alias(f"_{c}") for c in levels], F.col(node).alias("node"))
    same = [F.col(c) == F.col(f"_{c}") for c in levels]
    n = F.count("node").over(Window.partitionBy(*levels))
    return wanted.join(have, same, "left").select(*levels, "node", (n > 1).alias("ambiguous"))


def covered(rows: DataFrame, features: list[str]) -> DataFrame:
    """feature, covered: whether some row has a value of it; one pass for all."""
    one = rows.agg(*[F.bool_or(F.col(c).isNotNull()).alias(c) for c in features])
    return one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, features)), F.array(*[F.coalesce(F.col(c), F.lit(False)) for c in features])))).select(F.col("key").alias("feature"), F.col("value").alias("covered"))


def display_faults(tables: dict[str, DataFrame], formats: dict[str, tuple[str, str]]) -> DataFrame:
    """format, feature, fault (missing, empty or ok) of every feature that a format of a type names."""
    spark = next(iter(tables.values())).sparkSession
    named = [(name, otype, f) for name, (otype, fmt) in formats.items() for f in fields(fmt)]
    rows = spark.createDataFrame([(n, t, f, f in tables[t].columns) for n, t, f in named], "format string, otype string, feature string, there boolean")
    seen = None
    for otype in {t for _, t, _ in named}:
        there = sorted({f for _, t, f in named if t == otype and f in tables[otype].columns})
        part = covered(tables[otype], there).withColumn("_t", F.lit(otype)).withColumnRenamed("feature", "_f") if there else None
        seen = part if seen is None else seen if part is None else seen.unionByName(part)
    if seen is None:
        return rows.select("format", "feature", F.lit("missing").alias("fault"))
    both = rows.join(seen, (F.col("otype") == F.col("_t")) & (F.col("feature") == F.col("_f")), "left")
    return both.select("format", "feature", F.when(~F.col("there"), "missing").when(F.col("covered"), "ok").otherwise("empty").alias("fault"))
