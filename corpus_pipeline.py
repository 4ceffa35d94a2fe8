"""A training-data pipeline over the documents table: quality, near duplicates, decontamination, mix, token ids.

Every stage takes (spark, docs, sf_dir), where docs is what the stage before kept, written and read again.
All but the last return the columns of documents.  The mix stage's decision is the order of the rows, which
the last stage takes from the files' names and row numbers and writes in.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandgraph.llm import cotrain, decontam, minhash, mixing, token_store
from strandgraph.llm.common import materialise, table
from strandgraph.llm.queries import END_ID, tokenizer_path
from strandgraph.sources.shared import delete, folder, scratch


def _without(docs: DataFrame, judge, verdict: str) -> DataFrame:
    """The documents of which ``judge`` gives no row (doc_id, ...) that ``verdict`` holds for.

    Rows that repeat an id are one document: it goes if one of its rows does.  Rows with a null id are judged and
    go under a hash of their columns, so equal rows go together."""
    content = [f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    named = docs.withColumn("__bare", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(*content)))
    out = judge(named).where(verdict).select(F.col("doc_id").alias("__dropped")).distinct()
    left = named.join(out, named["doc_id"] == out["__dropped"], "left_anti")
    return left.withColumn("doc_id", F.when(~F.col("__bare"), F.col("doc_id")).cast(docs.schema["doc_id"].dataType)).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects.

    Rows that repeat an id are one document: it goes if one of its rows is rejected.  Without labels of both kinds
    nothing is rejected; an empty table stays empty; other columns pass through."""
    labels, pages = table(spark, sf_dir, "labels"), table(spark, sf_dir, "pages")
    return _without(docs, lambda rows: cotrain.classify(rows, labels, pages), "NOT kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the smallest doc_id, where no id repeats.

    Rows of one id with different texts, and rows with a null id, are documents of their own, which go under a 64-bit
    hash of id and text; of rows with equal id and text one stays, with the smallest source, lang and n_chars (nulls
    first).  Null and empty texts without an equal id stay; an empty table stays empty; other columns pass through."""
    again = materialise(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__again")).agg(F.count("*").alias("__n")).where("__n > 1").select("__again"), "repeated-keys")
    unique = not again.take(1) and not docs.where("doc_id IS NULL").take(1)
    unit = F.col("doc_id").cast("long")
    if unique:
        named = docs.withColumn("__unit", unit)
    else:
        apart = F.col("doc_id").isNull() | F.col("__again").isNotNull()
        named = docs.join(again, docs["doc_id"] == again["__again"], "left").withColumn("__apart", apart)
        named = materialise(named.withColumn("__unit", F.when(apart, F.xxhash64("doc_id", F.col("text").isNull(), "text")).otherwise(unit)).drop("__again"), "named")
    found = minhash.near_duplicates(named.select(F.col("__unit").alias("doc_id"), "text"))
    out = found.where("NOT kept").select(F.col("doc_id").alias("__dropped")).distinct()
    left = named.join(out, named["__unit"] == out["__dropped"], "left_anti")
    if unique:
        return left.select(*docs.columns)
    order = [c for c in ("source", "lang", "n_chars") if c in docs.columns]
    order += [f.name for f in docs.schema if f.name not in order and f.dataType.typeName() not in ("map", "variant")]
    one = left.where("__apart").groupBy("__unit").agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("__row"))
    return left.where("NOT __apart").select(*docs.columns).unionByName(one.select("__row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item.

    Rows that repeat an id are one document: it goes if one of its rows holds a window.  A null text holds none; an
    empty benchmark drops nothing; other columns pass through."""
    items = table(spark, sf_dir, "benchmark")
    return _without(docs, lambda rows: decontam.report(decontam.matches(rows, items)), "contaminated")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents into the order of the Pfair schedule; drops none.

    A null source is a source of its own; rows that repeat an id or a whole row each have a place; an empty table
    stays empty; other columns pass through."""
    return mixing.mix(docs, carry=True).orderBy("mix_position").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, order: list[Column] | None = None) -> DataFrame:
    """Writes the token ids in the order of the rows and returns what the files say of each document.

    Rows read from files lie in the order of the files and of the rows in them: a name's part number, then the number
    of the file within its part, as a task that splits its output gives several; files named otherwise come first, by
    name.  Rows that come from no file have no place, so the caller gives the ``order``; without one they are put in
    that of doc_id, with a warning.  Null and empty texts have only the end id; rows that repeat an id, also the null
    id, each have a row; an empty table gives an empty result; other columns are ignored."""
    if order is not None:
        docs = materialise(docs.orderBy(*order).select("doc_id", "text"), "ordered")
    try:
        docs.select("_metadata.file_name")
    except AnalysisException:
        warnings.warn("the rows come from no file; their ids are written in the order of doc_id", stacklevel=2)
        return token_store.round_trip(docs, tokenizer_path(), END_ID)
    name = F.col("_metadata.file_name")
    number = lambda k: F.lpad(F.regexp_extract(name, "^part-(\\d+)-.*?-c(\\d+)\\.", k), 20, "0")
    placed = docs.select("doc_id", "text", F.concat(number(1), number(2), name).alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return token_store.round_trip(placed, tokenizer_path(), END_ID, (F.col("__file"), F.col("__row")))


STAGES = [("quality classifier", quality), ("minhash near-dedup", near_duplicates), ("benchmark decontamination", decontaminate), ("mixing", mix), ("token ids", tokens)]

#: The classifier and the tokenizer have no SQL.  Tests hold near-dedup and decontamination against plain Python row by
#: row, the classifier's stage against its verdicts, and the mix's order and each document's ids against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages.  What a stage wrote for itself goes when its result is written, and that when the next one is."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = folder(spark, name.replace(" ", "-"))
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if last is not None:
            delete(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
