"""The store's plans: one type is read alone, and types of one document join without an Exchange."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from strandgraph.sources import store


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_join_without_exchange_and_one_partition_read(spark):
    rows = [(t, d, 100 * d + i, 10 * i, 10 * i + 9 if t == "word" else 10 * i) for t in ("word", "sign", None) for d in [*range(40), None] if d is not None or t == "sign" for i in range(5) for d in [d or 0]]
    nodes = spark.createDataFrame(rows, "otype string, doc int, node int, lo int, hi int")
    name = store.save(nodes, buckets=8)
    words, signs = store.nodes_of(spark, name, "word"), store.nodes_of(spark, name, "sign")
    inner = signs.select(F.col("doc").alias("d"), F.col("node").alias("sign"), F.col("lo").alias("at"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = words.join(inner, (F.col("doc") == F.col("d")) & F.col("at").between(F.col("lo"), F.col("hi")))
        said = plan(joined)
        got = sorted((r.node, r.sign) for r in joined.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in said and "PartitionFilters: [isnotnull(otype" in said and "SelectedBucketsCount" in said
    assert got == sorted((w[2], s[2]) for w in rows if w[0] == "word" for s in rows if s[0] == "sign" and w[1] == s[1] and w[3] <= s[3] <= w[4])
    assert store.nodes_of(spark, name, "none").count() == 200
