"""Near duplicates by one-permutation hashing with optimal densification.

One hash of each shingle puts it into one of ``bins`` bins; a bin keeps its smallest value.  An empty bin
borrows from the first non-empty one that a shared hash sequence names (optimal densification).  Bands of
``rows`` bins are bucket keys.  In each bucket every member is first paired only with the bucket's smallest id,
a star, which joins most groups with pairs that grow with the members.

What the stars leave apart is settled without dropping a pair.  In a bucket of at most ``few`` members those of
different components meet.  The members of larger buckets meet by an exact set join among themselves, in which
a shingle is rare if at most ``few`` of these documents hold it:

* a linked pair that shares a rare shingle has its rarest shared one in both prefixes (the n - ceil(0.8 n) + 1
  rarest shingles of a set of n), so pairs come from the few holders of such shingles;
* any other linked pair shares only frequent shingles.  Documents with equal frequent parts form a group, and a
  star around the smallest of a group, and around the smallest of every other group that shares a bucket, joins
  all that are linked: with equal overlap a smaller set is only more similar.

So the components are at least those of all pairs that share a bucket; only pairs that share none (5e-6 at a
similarity of 0.8) are missed.  Documents with equal shingle sets are one class and take part once.  Links are
confirmed on full sets.

Edge cases: null texts and texts without words have an empty set and are linked with nothing; a null id is
linked with nothing and is its own (null) component, kept; rows that repeat an id are one document, whose text is
the smallest of theirs, and all get its figures; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytescan import LOWER, NOT_SPACE, mix, runs, word_hashes, words
from .common import bound_batches, lean, materialise, pieces, sized, utf8_buffers
from .components import connected_components

#: Bands x rows of bins: a pair of similarity 0.8 is missed with a probability near 5e-6, one of 0.2 meets with 0.003.
BANDS, ROWS = 40, 6
#: Members that meet pair by pair: of a bucket, and of the holders of a rare shingle.
FEW = 32


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of every distinct shingle, sorted by both; fewer than k words are one shingle."""
    data = LOWER[data]
    starts, ends, doc = words(data, offsets, NOT_SPACE)
    h = word_hashes(data, starts, ends, NOT_SPACE)
    whole = runs(h, k)
    inside = doc[: len(whole)] == doc[k - 1 :] if len(whole) else np.zeros(0, bool)
    docs, values = [doc[: len(whole)][inside]], [whole[inside]]
    counts = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            docs.append(short)
            values.append(runs(h, n)[first[short]])
    docs, values = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    return docs[new], values[new]


def signatures(docs: np.ndarray, values: np.ndarray, n: int, bins: int) -> np.ndarray:
    """n x bins densified minima; rows of documents without shingles are zero."""
    out, full = np.zeros((n, bins), np.uint64), np.zeros((n, bins), bool)
    place = ((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    at = docs * bins + place.astype(np.int64)  # sorted, as values are within a document
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    out.reshape(-1)[at[first]] = values[first]
    full.reshape(-1)[at[first]] = True
    some = full.any(axis=1)
    row, col = np.nonzero(~full & some[:, None])
    stride = np.full(1, 0x9E3779B97F4A7C15, np.uint64)
    step = np.zeros(1, np.uint64)
    seed = mix(col.astype(np.uint64) + np.uint64(1))
    while len(row):
        step = step + stride
        probe = (mix(seed + step) % np.uint64(bins)).astype(np.int64)
        good = full[row, probe]
        out[row[good], col[good]] = out[row[good], probe[good]]
        row, col, seed = row[~good], col[~good], seed[~good]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each document and band."""
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def sketch(docs: DataFrame, text: str, key: str, k: int, bands: int, rows: int) -> DataFrame:
    """Per document: its set's size, a 128-bit digest of the set, and its bucket keys."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            for i, j in pieces(offsets):
                owner, values = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                n = j - i
                size = np.bincount(owner, minlength=n)
                filled = np.flatnonzero(size)
                digest = np.zeros((2, n), np.uint64)
                keys = np.zeros((0, bands), np.uint64)
                if len(filled):
                    at = np.cumsum(size[filled]) - size[filled]
                    for r in range(2):
                        digest[r, filled] = np.add.reduceat(mix(values + np.uint64(r + 1)), at)
                    keys = band_keys(signatures(owner, values, n, bands * rows), bands, rows)[filled]
                ends = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array(size, pa.int64()), *[pa.array(d.view(np.int64), pa.int64(), mask=size == 0) for d in digest], pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64)))],
                    ["key", "n_shingles", "d1", "d2", "buckets"],
                )

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(lean(run), "key long, n_shingles long, d1 long, d2 long, buckets array<long>")


def _confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity.  Texts meet pairs by b, then by a; rows of one a
    are neighbours, so its set is made once, and a hot a is split by AQE since nothing later needs it together."""

    def run(batches):
        held, of = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            data, offsets = utf8_buffers(batch.column(3))
            for i, j in pieces(offsets):
                owner, values = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                cut = np.searchsorted(owner, np.arange(j - i + 1))
                for r in range(i, j):
                    if held != a[r]:
                        one = batch.column(2).slice(r, 1)
                        of = shingles(*utf8_buffers(one), k)[1]
                        held = a[r]
                    other = values[cut[r - i] : cut[r - i + 1]]
                    small, large = (of, other) if len(of) <= len(other) else (other, of)
                    at = np.minimum(np.searchsorted(large, small), max(len(large) - 1, 0))
                    common = int(np.count_nonzero(large[at] == small)) if len(small) else 0
                    keep.append(100 * common >= percent * (len(of) + len(other) - common) and common > 0)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    with_b = pairs.join(texts.select(F.col("key").alias("kb"), F.col("text").alias("text_b")), F.col("b") == F.col("kb")).select("a", "b", "text_b")
    with_a = with_b.join(texts.select(F.col("key").alias("ka"), F.col("text").alias("text_a")), F.col("a") == F.col("ka")).select("a", "b", "text_a", "text_b")
    return with_a.mapInArrow(lean(run), "a long, b long")


def linked(docs: DataFrame, sketched: DataFrame, classes: DataFrame, text: str, key: str, k: int, percent: int) -> DataFrame:
    """Components (id, component) of the confirmed links between class representatives."""
    reps = classes.select(F.col("rep"), F.col("c1"), F.col("c2"))
    rows = sketched.join(reps, (F.col("key") == F.col("rep")) & (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")))
    spread = rows.select("key", "n_shingles", F.explode("buckets").alias("bucket"))
    crowd = spread.groupBy(F.col("bucket").alias("k")).agg(F.count("*").alias("m")).where("m > 1").select("k")
    members = materialise(spread.join(crowd, F.col("bucket") == F.col("k")).select("bucket", "key", "n_shingles").distinct(), "members")
    wanted = members.select(F.col("key").alias("w")).distinct()
    texts = materialise(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(wanted, F.col("key") == F.col("w"), "left_semi"), "texts")
    hubs = members.groupBy(F.col("bucket").alias("k")).agg(F.min(F.struct("key", "n_shingles")).alias("h")).select("k", F.col("h.key").alias("other"), F.col("h.n_shingles").alias("n"))
    hubs = materialise(hubs, "hubs")
    tied = members.join(hubs, (F.col("bucket") == F.col("k")) & (F.col("other") < F.col("key")) & _near_sizes(percent))
    good = materialise(_confirm(_pairs(tied, "other", "key"), texts, k, percent), "links")
    components, ids = connected_components(good)
    # the centres have met all of their buckets; of the other members, those of different components meet now
    rest = members.join(hubs, (F.col("bucket") == F.col("k")) & (F.col("key") == F.col("other")), "left_anti")
    rest = materialise(rest.join(sized(components, ids), F.col("key") == F.col("id"), "left").select("bucket", "key", "n_shingles", F.coalesce("component", "key").alias("part")), "members")
    mixed = rest.groupBy(F.col("bucket").alias("k")).agg(F.count("*").alias("m"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    mixed = materialise(mixed.select("k", "m"), "mixed")
    small = materialise(rest.join(mixed.where(F.col("m") <= FEW), F.col("bucket") == F.col("k"), "left_semi"), "members")
    large = materialise(rest.join(mixed.where(F.col("m") > FEW), F.col("bucket") == F.col("k"), "left_semi"), "members")
    others = small.select(F.col("bucket").alias("k"), F.col("key").alias("other"), F.col("n_shingles").alias("n"), F.col("part").alias("other_part"))
    apart = small.join(others, (F.col("bucket") == F.col("k")) & (F.col("other") < F.col("key")) & (F.col("part") != F.col("other_part")) & _near_sizes(percent))
    found = [_pairs(apart, "other", "key")]
    if large.take(1):
        found += _remainder(large, texts, k, percent)
    more = materialise(_confirm(_pairs(reduce(DataFrame.unionByName, found), "a", "b"), texts, k, percent), "links")
    if not more.take(1):
        return components
    # what is known so far goes on as one edge for each id, not as all its links
    return connected_components(more.unionByName(components.select(F.col("id").alias("a"), F.col("component").alias("b"))))[0]


def _near_sizes(percent: int) -> Column:
    """Whether sets of n_shingles and n can reach the similarity: it is at most the smaller size over the larger."""
    return 100 * F.least("n_shingles", "n") >= percent * F.greatest("n_shingles", "n")


def _pairs(met: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct pairs (a, b), the smaller id first; written, so later joins know their size."""
    return materialise(met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "pairs")


def _tokens(texts: DataFrame, k: int) -> DataFrame:
    """key, t: every distinct shingle of every text."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in pieces(offsets):
                owner, values = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:j][owner], pa.int64()), pa.array(values.view(np.int64))], ["key", "t"])

    return texts.select("key", "text").mapInArrow(lean(run), "key long, t long")


def _remainder(large: DataFrame, texts: DataFrame, k: int, percent: int) -> list[DataFrame]:
    """Candidate pairs (a, b) among the members of large buckets that hold every link between different parts."""
    whole = materialise(large.groupBy("key").agg(F.min("n_shingles").alias("n"), F.min("part").alias("part"), F.sort_array(F.collect_set("bucket")).alias("at")), "crowded")
    held = _tokens(texts.join(whole.select(F.col("key").alias("w")), F.col("key") == F.col("w"), "left_semi"), k)
    held = materialise(held, "shingles")
    often = materialise(held.groupBy(F.col("t").alias("u")).agg(F.count("*").alias("df")), "shingle-counts")
    counted = materialise(held.join(often, F.col("t") == F.col("u")).select("key", "t", "df"), "shingles")
    hot = F.col("df") > FEW
    sums = counted.groupBy(F.col("key").alias("w")).agg(
        F.count_if(F.col("df") == 1).alias("ones"), F.count_if(hot).alias("hot"), F.bit_xor(F.when(hot, F.xxhash64("t"))).alias("s1"), F.bit_xor(F.when(hot, F.xxhash64("t", F.lit(1)))).alias("s2")
    )
    whole = materialise(whole.join(sums, F.col("key") == F.col("w")).drop("w"), "crowded")

    # pairs that share a rare shingle: by those in the prefix, which lone shingles fill first
    prefix = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    room = whole.select(F.col("key").alias("w"), F.col("n").alias("n_shingles"), "part", (prefix - F.col("ones")).alias("room")).where("room > 0")
    rare = counted.where(F.col("df").between(2, FEW)).join(room, F.col("key") == F.col("w"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("df", "t"))
    rare = materialise(rare.withColumn("place", place).where("place <= room").select("t", "key", "n_shingles", "part"), "prefixes")
    others = rare.select(F.col("t").alias("u"), F.col("key").alias("other"), F.col("n_shingles").alias("n"), F.col("part").alias("other_part"))
    by_rare = rare.join(others, (F.col("t") == F.col("u")) & (F.col("other") < F.col("key")) & (F.col("part") != F.col("other_part")) & _near_sizes(percent))

    # pairs that share frequent shingles only: the frequent parts bound the overlap
    able = whole.where(100 * F.col("hot") >= percent * F.col("n")).select("key", "n", "part", "hot", "s1", "s2", "at")
    groups = able.groupBy("s1", "s2").agg(F.min(F.struct("n", "key", "part", "hot")).alias("c"), F.count("*").alias("m"), F.min("at").alias("at"))
    groups = groups.select(F.col("s1").alias("g1"), F.col("s2").alias("g2"), F.col("c.key").alias("other"), F.col("c.n").alias("other_n"), F.col("c.part").alias("other_part"), F.col("c.hot").alias("other_hot"), F.when(F.col("m") == 1, F.col("at")).alias("only"))
    groups = materialise(groups, "groups")
    reach = (F.col("key") != F.col("other")) & (F.col("part") != F.col("other_part")) & ((100 + percent) * F.least("hot", "other_hot") >= percent * (F.col("n") + F.col("other_n")))
    same = (F.col("s1") == F.col("g1")) & (F.col("s2") == F.col("g2"))
    by_group = able.join(groups, same & reach)
    spread = materialise(able.withColumn("bucket", F.explode("at")), "members")
    present = spread.select(F.col("bucket").alias("b"), F.col("s1").alias("p1"), F.col("s2").alias("p2")).distinct()
    centres = materialise(present.join(groups, (F.col("p1") == F.col("g1")) & (F.col("p2") == F.col("g2"))).drop("p1", "p2"), "centres")
    # a document meets a group of one in the first bucket that both are in
    first = F.col("only").isNull() | (F.array_min(F.array_intersect("at", "only")) == F.col("bucket"))
    across = spread.join(centres, (F.col("bucket") == F.col("b")) & ~same & reach & first)
    return [_pairs(df, "other", "key") for df in (by_rare, by_group, across)]


def _documents(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame | None]:
    """key, text with each id once (rows that repeat an id: their smallest text), and the repeated ids, if any."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    again = materialise(rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("again")), "repeated-ids")
    if not again.take(1):
        return rows, None
    once = rows.join(again, F.col("key") == F.col("again"), "left_anti")
    return once.unionByName(rows.join(again, F.col("key") == F.col("again"), "left_semi").groupBy("key").agg(F.min("text").alias("text"))), again


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: n_shingles, the smallest doc_id of its component, and whether it is that document."""
    bound_batches(docs.sparkSession)
    whole, again = _documents(docs, text, key)
    sketched = materialise(sketch(whole, "text", "key", k, bands, rows), "sketches")
    classes = materialise(sketched.where("n_shingles > 0 AND key IS NOT NULL").groupBy(F.col("d1").alias("c1"), F.col("d2").alias("c2")).agg(F.min("key").alias("rep")), "classes")
    components = linked(whole, sketched, classes, "text", "key", k, percent)
    named = classes.join(components, F.col("rep") == F.col("id"), "left").select("c1", "c2", F.coalesce("component", "rep").alias("component"))
    named = materialise(named, "classes")
    joined = sketched.join(named, (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")), "left")
    own = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    out = joined.select(F.col("key").alias("doc_id"), "n_shingles", own.alias("component_id"), F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"))
    if again is None:
        return out
    repeats = docs.select(F.col(key).cast("long").alias("_id")).join(again, F.col("_id") == F.col("again"), "left_semi")
    once = out.join(again, F.col("doc_id") == F.col("again"), "left_anti")
    return once.unionByName(repeats.join(out, F.col("_id") == F.col("doc_id")).drop("_id"))
