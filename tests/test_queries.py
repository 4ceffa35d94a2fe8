"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import glob
import os
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from strandgraph.plans import registry

SF = "/root/testdata/sf0.001"


def plain(v):  # numbers alike, whatever their type
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return "NULL"
    if type(v).__name__ in ("bool", "bool_"):
        return str(bool(v))
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, (int, float)):
        return repr(round(float(v), 6))
    return str(v)


def bag(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p + '/*' if os.path.isdir(p) else p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got) == bag(want)


def test_all_words(spark):
    """Every word with its line and place, against plain Python."""
    docs = pd.read_parquet(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    want = [(k, i, j, w) for k, t in docs.itertuples(index=False) if t is not None for i, line in enumerate(t.split("\n"), 1) for j, w in enumerate(filter(None, line.split(" ")), 1)]
    got = [tuple(r) for r in registry.QUERIES["word_tokens"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and max(r[2] for r in got) > 3


def test_all_gazetteer_matches(spark):
    """Matches of every word, short ones too, against plain Python."""
    docs, items = (pd.read_parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    n = Counter(w for t in docs.text.dropna() for w in re.findall("[^ \n]+", t))
    want = {k: sum(n[w] for w in words) for k, t in zip(items.item_id, items.text) if (words := set(re.findall("[^ \n]+", t)) & n.keys())}
    assert {r.item_id: r.n for r in registry.QUERIES["gazetteer_tag"](spark, SF).collect()} == want


def test_bag_of_keys_names_every_key(spark, tmp_path):
    """A missing and an extra key of one residue don't cancel."""
    spark.createDataFrame([(1,), (2,), (105,), (205,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1,), (1,), (2,), (305,), (205,)], "l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = registry.QUERIES["bag_equal"](spark, str(tmp_path)).collect()
    assert sorted((r.k, r.n_a, r.n_b) for r in got) == [(105, 1, 0), (305, 0, 1)]
