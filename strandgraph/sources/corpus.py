"""Files of a corpus: scan, stable keys, byte slices, identity, releases, reports and split modules."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators import audit, ordered


@F.pandas_udf(StringType())
def composed(texts: pd.Series) -> pd.Series:
    """Unicode's composed form (NFC), for which Spark has no function."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def scan(spark: SparkSession, root: str, suffix: str = "xml") -> DataFrame:
    """src_file, content, size of all files below ``root``; nothing is read before a column needs it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}").load(root)
    return files.select(stable_key(F.col("path"), root).alias("src_file"), "content", F.col("length").alias("size"))


def stable_key(path: Column, root: str) -> Column:
    """The path below ``root``, composed, with forward slashes; the scheme doesn't matter."""
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")
    below = "/" + root.split("://", 1)[-1].strip("/") + "/"
    return composed(F.replace(F.replace(bare, F.lit(below), F.lit("")), F.lit("%20"), F.lit(" ")))


def ordinals(files: DataFrame, key: str = "src_file", ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds ordinal: the place in the order of the folded key, then of the key, then of ``ties``.  Places are counted in
    ranges of the order, so no task holds all files; the ranges are written once, as each evaluation would draw others."""
    order = [F.lower(key), F.col(key), *map(F.col, ties)]
    ranged = ordered.dealt(files, [], order)
    local = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = ranged.groupBy(F.col("_p").alias("_q")).agg(F.count("*").alias("_m"))
    before = sizes.select("_q", (F.sum("_m").over(Window.orderBy("_q")) - F.col("_m")).alias("_b"))  # one row a partition
    return local.join(F.broadcast(before), F.col("_p") == F.col("_q")).withColumn("ordinal", F.col("_b") + F.col("_n")).drop("_p", "_n", "_q", "_b")


def sliced(content: Column, start: Column, end: Column) -> Column:
    """Bytes start to end (exclusive) of a binary column."""
    return F.when(start.isNotNull() & end.isNotNull(), F.substring(content, start.cast("int") + 1, (end - start).cast("int")))


def verified(files: DataFrame, lock: DataFrame, key: str = "src_file") -> DataFrame:
    """key, status: ok, altered, unlocked (the lock list has no hash for it), missing or unexpected, by a lock list (key,
    sha256).  A null key is a key; a file without content is altered."""
    both = audit.outer(lock.select(key, F.lower("sha256").alias("sha")), files.select(key, F.sha2("content", 256).alias("sha")), [key])
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(F.col("a.sha").isNull(), "unlocked").when(~F.col("a.sha").eqNullSafe(F.col("b.sha")), "altered").otherwise("ok")
    return both.select(key, status.alias("status"))


def releases(files: DataFrame, release: str) -> DataFrame:
    """A record for each file of a release, told from its path and bytes without parsing."""
    parts = F.split("src_file", "/")
    top = F.get(parts, F.lit(0))
    docid = F.regexp_extract(F.decode("content", "utf-8"), "<docID>([^<]*)</docID>", 1)
    return files.select(
        F.lit(release).alias("release"), F.col("src_file").alias("rel"), top.alias("top_dir"), F.regexp_extract(top, "^CTH ([0-9]+)", 1).alias("cth"), F.regexp_extract(top, "_XML_(.+)$", 1).alias("project"), F.regexp_replace(F.element_at(parts, -1), "\\.xml$", "").alias("stem"), docid.alias("docid"), F.sha2("content", 256).alias("sha256")
    )


def directories(files: DataFrame) -> DataFrame:
    """dir, files, bytes of every folder on some file's way."""
    parts = F.split("src_file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return files.where(F.size(parts) > 1).select("src_file", "size", F.explode(above).alias("dir")).groupBy("dir").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def split_modules(rows: DataFrame, key: str, optional: list[str]) -> tuple[DataFrame, DataFrame]:
    """The main columns, and the optional ones beside the key for their own location."""
    return rows.drop(*optional), rows.select(key, *optional)


def load_modules(main: DataFrame, others: list[DataFrame], key: str, wanted: list[str]) -> DataFrame:
    """The key and the wanted columns; a module is joined only if a wanted column lies in it."""
    out = main
    for other in others:
        need = [c for c in wanted if c in other.columns and c not in main.columns]
        if need:
            out = out.join(other.select(key, *need), key, "left")
    return out.select(key, *[c for c in wanted if c != key])


def entries(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """reading, sequence, n, fault of a two-column map given as lines: empty, unusable (no value, or more than one
    column too many) or duplicate; comment lines are left out."""
    rows = lines.where(~F.col("value").startswith("#"))
    parts = F.split("value", sep, -1)
    read = rows.select(F.trim(F.get(parts, F.lit(0))).alias("reading"), F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("sequence"), F.size(parts).alias("columns"))
    counts = read.groupBy(F.col("reading").alias("_r")).agg(F.count("*").alias("n"))
    n, read = F.col("n"), read.join(counts, F.col("reading").eqNullSafe(F.col("_r")))
    fault = F.when(F.col("reading") == "", "empty").when((F.col("sequence") == "") | (F.col("columns") > 3), "unusable").when(n > 1, "duplicate")
    return read.select("reading", "sequence", "n", fault.alias("fault"))


def report_lines(rows: DataFrame, title: str, most: int = 10_000) -> list[str]:
    """A small result as Markdown, its rows in the order of all columns; ValueError beyond ``most`` rows."""
    names = rows.columns
    cells = [[str(v) for v in r] for r in rows.orderBy(*names).limit(most + 1).collect()]
    if len(cells) > most:
        raise ValueError(f"more than {most} rows: write the table instead")
    return [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "-|" * len(names), *("| " + " | ".join(c) + " |" for c in cells)]
