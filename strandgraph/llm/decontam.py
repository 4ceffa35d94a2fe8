"""Benchmark decontamination as a prefix-filtered set join.

Every run of ``window`` item words (the whole item if it is shorter) is a set to be contained in a document.
Words are ordered by how often the corpus holds them; for full containment the necessary prefix is a window's
rarest word, so only documents' occurrences of such words are candidates.  The word's place in the window
gives the positional bound (where the window would start), the document's length the other bound, and the
candidate is compared word by word.

The corpus counts are a map-side count of benchmark words, summed.  The windows go to executors as flat arrays, in
blocks of at most ``block_bytes`` of item text (an index of about 15 times that); one pass over the documents handles
a block.  A benchmark of more blocks costs two passes for each, with the documents written between them, so no worker
ever holds two blocks.

Edge cases: null and empty texts have no words and aren't contaminated; an item without words has no window;
rows that repeat an item_id count once; a null item_id is never reported as an id, but its windows do hit;
an empty benchmark leaves every document clean; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import ALNUM, LOWER, runs, word_hashes, words
from .common import bound_batches, lean, materialise, pieces, utf8_buffers

#: Item text whose windows one pass holds in memory.
BLOCK_BYTES = 8 << 20


def _lowered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8_buffers(pa.array(texts, pa.string()))
    return LOWER[data], offsets


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Lists of (item_id, text), each of at most ``block_bytes`` of text or one longer item."""
    rows, size = [], 0
    for r in benchmark.where("text IS NOT NULL").select("item_id", "text").orderBy("item_id").toLocalIterator():
        if rows and size + len(r["text"]) > block_bytes:
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if rows:
        yield rows


def _vocabulary(texts: list[str | None]) -> np.ndarray:
    """The sorted hashes of the texts' words."""
    data, offsets = _lowered(texts)
    starts, ends, _ = words(data, offsets, ALNUM)
    return np.unique(word_hashes(data, starts, ends, ALNUM))


def _frequency(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """How often the whole corpus holds each word of the sorted hash array."""
    wanted = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = wanted.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(0))
            for i, j in pieces(offsets):
                part = LOWER[data[offsets[i] : offsets[j]]]
                starts, ends, _ = words(part, offsets[i : j + 1] - offsets[i], ALNUM)
                h = word_hashes(part, starts, ends, ALNUM)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                total += np.bincount(at[known[at] == h], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["word", "n"])

    counted = np.zeros(len(vocabulary), np.int64)
    for r in docs.select(F.col(text).alias("text")).mapInArrow(lean(run), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        counted[r["word"]] = r["n"]
    return counted


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words with one space after each, and where each begins (and the end), so that windows compare as slices."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(at[-1]), 0x20, np.uint8)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at[:-1], size) + place] = data[np.repeat(starts, size) + place]
    return out.tobytes(), at


class Windows:
    """The distinct windows of a block of items as arrays, found by the hash of their rarest word.

    A rare word has some ways (place in the window, words of the window); each window belongs to one."""

    def __init__(self, items: list[tuple], window: int, vocabulary: np.ndarray, counted: np.ndarray):
        data, offsets = _lowered([t for _, t in items])
        starts, ends, owner = words(data, offsets, ALNUM)
        h = word_hashes(data, starts, ends, ALNUM)
        self.text, self.at = _joined(data, starts, ends)
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.lexsort((vocabulary, counted))] = np.arange(len(vocabulary))  # rarest first, ties by hash
        rank = rank[np.searchsorted(vocabulary, h)]
        size = np.bincount(owner, minlength=len(items))
        parts = []
        for n in np.unique(np.minimum(size[size > 0], window)).tolist():
            whole = runs(h, n)
            mine = np.flatnonzero((owner[: len(whole)] == owner[n - 1 :]) & (np.minimum(size, window)[owner[: len(whole)]] == n))
            rare = np.lib.stride_tricks.sliding_window_view(rank, n)[mine].argmin(axis=1)
            parts.append((whole[mine], np.full(len(mine), n), mine, rare))
        none = [np.zeros(0, np.uint64)] + [np.zeros(0, np.int64)] * 3
        code, n, begin, rare = (np.concatenate(x) for x in zip(none, *parts))
        # one entry for each distinct window; windows of equal hash that differ as text stay apart
        order = np.lexsort((begin, code))
        code, n, begin, rare = code[order], n[order], begin[order], rare[order]
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        for i in np.flatnonzero(~new):
            new[i] = self._slice(begin[i], n[i]) != self._slice(begin[i - 1], n[i - 1])
        kept = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        pairs = np.unique(np.column_stack([group, owner[begin]]).astype(np.int64), axis=0) if len(group) else np.zeros((0, 2), np.int64)
        self.item_first = np.searchsorted(pairs[:, 0], np.arange(len(kept) + 1))
        self.items = pairs[:, 1].astype(np.int32)
        self.ids = [i for i, _ in items]
        self.code, self.n, self.begin = code[kept], n[kept].astype(np.int32), begin[kept]
        word = h[self.begin + rare[kept]]
        ways = np.column_stack([word, rare[kept].astype(np.uint64), self.n.astype(np.uint64)])
        ways, way = np.unique(ways, axis=0, return_inverse=True) if len(kept) else (np.zeros((0, 3), np.uint64), np.zeros(0, np.int64))
        self.way = way.reshape(-1).astype(np.int32)
        self.way_place, self.way_n = ways[:, 1].astype(np.int64), ways[:, 2].astype(np.int64)
        self.hashes, at = np.unique(ways[:, 0], return_index=True)
        self.way_first = np.concatenate([at, [len(ways)]])
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def _slice(self, begin: int, n: int) -> bytes:
        return self.text[self.at[begin] : self.at[begin + n]]

    @property
    def bytes(self) -> int:
        arrays = (self.at, self.item_first, self.items, self.code, self.n, self.begin, self.way, self.way_place, self.way_n, self.hashes, self.way_first, self.filter)
        return len(self.text) + sum(x.nbytes for x in arrays)

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """Words of each document, then for documents with hits: (first word, end) runs and the item ids."""
        data = LOWER[data]
        starts, ends, doc = words(data, offsets, ALNUM)
        n_words = np.bincount(doc, minlength=len(offsets) - 1)
        found: dict[int, tuple[list, set]] = {}
        if not len(starts) or not len(self.hashes):
            return n_words, found
        h = word_hashes(data, starts, ends, ALNUM)
        maybe = np.flatnonzero(self.filter[(h & np.uint64(0xFFFFF)).astype(np.int64)])
        rare = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        good = self.hashes[rare] == h[maybe]
        place, rare = maybe[good], rare[good]
        many = self.way_first[rare + 1] - self.way_first[rare]
        way = np.repeat(self.way_first[rare], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        word = np.repeat(place, many)
        first = np.concatenate([[0], np.cumsum(n_words)])
        a, n = word - self.way_place[way], self.way_n[way]
        inside = (a >= first[doc[word]]) & (a + n <= first[doc[word] + 1])  # positional and length bounds
        a, n, way = a[inside], n[inside], way[inside]
        text = at = None
        for size in np.unique(n).tolist():
            mine = np.flatnonzero(n == size)
            codes = runs(h, size)[a[mine]]
            low = np.minimum(np.searchsorted(self.code, codes), len(self.code) - 1)
            same = self.code[low] == codes
            for i, k, code in zip(mine[same].tolist(), low[same].tolist(), codes[same]):
                if text is None:
                    text, at = _joined(data, starts, ends)
                begin = int(a[i])
                got = text[at[begin] : at[begin + size]]
                while k < len(self.code) and self.code[k] == code:  # word by word
                    if self.way[k] == way[i] and self._slice(self.begin[k], size) == got:
                        d = int(doc[begin])
                        spans, names = found.setdefault(d, ([], set()))
                        spans.append((begin - int(first[d]), begin - int(first[d]) + size))
                        names.update(x for j in self.items[self.item_first[k] : self.item_first[k + 1]].tolist() if (x := self.ids[j]) is not None)
                    k += 1
        return n_words, found


_STATE = "n_words long, runs array<struct<a:int,b:int>>, items array<long>"


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its words, the runs of words inside occurring windows and the ids of their items."""
    spark = docs.sparkSession
    bound_batches(spark)
    run_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    state = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr("array()").cast("array<struct<a:int,b:int>>").alias("runs"), F.expr("array()").cast("array<long>").alias("items"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, text string, {_STATE}"
    done = 0
    for items in _blocks(benchmark, block_bytes):
        vocabulary = _vocabulary([t for _, t in items])
        counted = _frequency(docs, text, vocabulary) if len(vocabulary) else np.zeros(0, np.int64)
        if done:
            state = materialise(state, "decontaminated")
        state = state.mapInArrow(lean(_pass(spark.sparkContext.broadcast(Windows(items, window, vocabulary, counted)), run_type)), schema)
        done += 1
    if not done:  # the words are counted all the same
        state = state.mapInArrow(lean(_pass(spark.sparkContext.broadcast(Windows([], window, np.zeros(0, np.uint64), np.zeros(0, np.int64))), run_type)), schema)
    return state.select("key", "n_words", "runs", "items")


def _pass(shared, run_type):
    def run(batches):
        index = shared.value
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            n_words, runs, items = [], batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for i, j in pieces(offsets):
                counts, found = index.hits(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n_words += counts.tolist()
                for d, (spans, ids) in found.items():
                    runs[i + d] = join_runs([*((r["a"], r["b"]) for r in runs[i + d]), *spans])
                    items[i + d] = sorted({*items[i + d], *ids})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(runs, run_type), pa.array(items, pa.list_(pa.int64()))], ["key", "text", "n_words", "runs", "items"])

    return run


def join_runs(spans: list[tuple[int, int]]) -> list[dict]:
    """The union of the spans as disjoint runs."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"a": a, "b": b} for a, b in out]


def report(found: DataFrame) -> DataFrame:
    """Counts, the digest of the item ids and the verdict."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + (r["b"] - r["a"]).cast("long"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(F.col("key").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def digest(item_ids) -> str:
    return hashlib.sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()
