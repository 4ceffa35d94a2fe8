"""Lists of signs in the shapes that they come in; every reader gives reading, sign and source, each row once.

A reading is put into one spelling by ``spelling``; rows without a reading or a sign are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import parsers
from ..operators import markup

Spelling = Callable[[Column], Column]


def _rows(found: DataFrame, source: str, spelling: Spelling) -> DataFrame:
    told = found.where("reading <> '' AND sign <> ''")
    return told.select(spelling(F.col("reading")).alias("reading"), "sign", F.lit(source).alias("source")).distinct()


def quoted_pairs(spark: SparkSession, path: str, source: str, unknown: str = "??", spelling: Spelling = parsers.reading_key) -> DataFrame:
    """Lines ``"reading": sign``, the sign quoted or not; other lines, and signs that are ``unknown``, are left out."""
    line = '^\\s*"([^"]+)"\\s*:\\s*"?([^\\s"#]+)'
    found = spark.read.text(path).select(F.regexp_extract("value", line, 1).alias("reading"), F.regexp_extract("value", line, 2).alias("sign"))
    return _rows(found.where(F.col("sign") != unknown), source, spelling)


def tab_pairs(spark: SparkSession, path: str, source: str, skip: str = "[×&@(]", spelling: Spelling = parsers.reading_key) -> DataFrame:
    """Lines ``reading TAB sign``; readings in which the pattern ``skip`` stands describe a shape or a measure."""
    parts = F.split("value", "\t", 2)
    found = spark.read.text(path).where(F.contains("value", F.lit("\t"))).select(parts[0].alias("reading"), parts[1].alias("sign"))
    return _rows(found.where(~F.col("reading").rlike(skip)), source, spelling)


@F.pandas_udf(ArrayType(StringType()))
def _names(texts: pd.Series) -> pd.Series:
    """What stands before the first bracket, and the comma-separated names in it without what is bracketed again."""

    def names(text: str | None) -> list[str]:
        head, _, rest = (text or "").partition("(")
        inner, left = markup.balanced(text or ""), None
        inner = rest if inner is None else inner
        while inner != left:
            left, inner = inner, re.sub(r"\([^()]*\)", "", inner)
        return [head, *inner.partition("(")[0].replace(")", "").split(",")]

    return texts.map(names)


def bracketed_names(spark: SparkSession, path: str, source: str, longest: int = 19, spelling: Spelling = parsers.reading_key) -> DataFrame:
    """CSV rows whose first field is the sign and whose third holds names such as ``A (B, C (see D), E)``.  A name ends
    at a colon; longer ones and those of several words are remarks."""
    rows = spark.read.csv(path, multiLine=True, escape='"', schema="sign string, number string, names string")
    each = rows.select("sign", F.explode(_names(F.replace("names", F.lit("\n"), F.lit(" ")))).alias("name"))
    found = each.select("sign", F.trim(F.regexp_replace("name", "\\s*:.*", "")).alias("reading"))
    return _rows(found.where((F.length("reading") <= longest) & ~F.contains("reading", F.lit(" "))), source, spelling)


def blocks(spark: SparkSession, path: str, series: str) -> DataFrame:
    """name, sign, readings, numbers of each ``@sign`` block.  The sign is the first ``@ucun`` before any ``@form``;
    a reading loses its qualifiers, and none begins with a minus; numbers are those of the ``series`` under ``@list``."""
    text = spark.read.text(path, wholetext=True).select(F.replace("value", F.lit("\r"), F.lit("")).alias("value"))
    block = text.select(F.explode(F.regexp_extract_all("value", F.lit("(?ms)^@sign[ \\t]+(.*?)(?=^@sign[ \\t]|^@end[ \\t]|\\z)"), F.lit(1))).alias("b"))

    def values(tag: str) -> Column:
        return F.regexp_extract_all("b", F.lit(f"(?m)^@{tag}[ \\t]+(.*?)[ \\t]*$"), F.lit(1))

    own = F.split("b", "(?m)^@form[ \\t]", 2)[0]
    bare = F.transform(values("v"), lambda v: F.regexp_extract(v, "^[%*]*([^\\s/]*?)\\?*(?:[\\s/]|$)", 1))
    readings = F.array_distinct(F.filter(bare, lambda v: (v != "") & ~F.startswith(v, F.lit("-"))))
    numbers = F.array_distinct(F.filter(F.transform(values("list"), lambda v: F.regexp_extract(v, f"^{re.escape(series)}0*(\\d+)", 1)), lambda v: v != ""))
    sign = F.regexp_extract(own, "(?m)^@ucun[ \\t]+(.*?)[ \\t]*$", 1)
    return block.select(F.regexp_extract("b", "^(.*?)[ \\t]*(?:\\n|$)", 1).alias("name"), F.nullif(sign, F.lit("")).alias("sign"), readings.alias("readings"), numbers.alias("numbers"))


def block_readings(spark: SparkSession, path: str, source: str, spelling: Spelling = parsers.reading_key) -> DataFrame:
    """The readings of ``blocks``, the name among them."""
    each = blocks(spark, path, "").select("sign", F.explode(F.concat("readings", F.array("name"))).alias("reading"))
    return _rows(each, source, spelling)


def same_number(listed: DataFrame) -> DataFrame:
    """sign, other: signs of ``blocks`` that share a number, each with itself; signs that share none are left out."""
    each = listed.where("sign IS NOT NULL").select("sign", F.explode("numbers").alias("number")).distinct()
    several = each.groupBy("number").agg(F.collect_set("sign").alias("signs")).where(F.size("signs") > 1)
    return several.select(F.explode("signs").alias("sign"), "signs").select("sign", F.explode("signs").alias("other")).distinct()
