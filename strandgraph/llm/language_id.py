"""Language identification by rank-order profiles.

A language's profile is the ranking of its most frequent character n-grams (1 to 3 letters, word borders
included); a document is given the language whose profile its own ranking is least out of place with.
The profiles are learned from at most about ``per_language`` documents of each language, chosen by a hash of
the key; their whole texts are counted.  Equal counts rank by n-gram, equal distances by language name.

Edge cases: null texts and texts without a letter are ``und`` with score 0, as is everything if no language
was learned; a null key isn't held out; rows with null lang aren't learned from; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, lean, materialise

#: n-grams in a language's profile and in a document's ranking; documents learned from for each language.
PROFILE, RANKED, PER_LANGUAGE = 400, 300, 2000
_BITS = 21  # of a code point
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
    return _letters


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of 1 to 3 code points as 63-bit numbers, and their counts; 0 stands for a word's border."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    letters = _is_letter()[codes]
    if not letters.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # a word's letters and one border after it
    codes = np.where(letters, codes, 0)[keep].astype(np.int64)
    codes = np.concatenate([[0], codes])
    two = codes[:-1] << _BITS | codes[1:]
    three = two[:-1] << _BITS | codes[2:]
    one = codes[codes > 0]
    two = two[(codes[:-1] > 0) | (codes[1:] > 0)] | 1 << 62
    three = three[codes[1:-1] > 0]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def _ranking(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, first first."""
    return grams[np.lexsort((grams, -counts))[:most]]


def held_out(key: Column) -> Column:
    """The documents that are never learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE, profile: int = PROFILE) -> dict[str, list[int]]:
    """The profile of each language.  The sample's bound is ``per_language`` in expectation."""
    bound_batches(docs.sparkSession)
    usable = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy(F.col(lang).alias("name")).count().toLocalIterator()}
    if not sizes:
        return {}
    share = F.coalesce(*[F.when(F.col(lang) == n, F.lit(min(1.0, per_language / c))) for n, c in sizes.items()])
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("profile")), F.lit(1 << 20)) < share * (1 << 20)

    def count(batches):
        totals: dict[str, list] = {}
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns)):
                totals.setdefault(name, []).append(ngrams(text))
        for name, parts in totals.items():
            grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            if len(grams):
                counts = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(counts)], ["name", "gram", "n"])

    counts = usable.where(drawn).select(F.col(lang).alias("name"), F.col(text).alias("text")).mapInArrow(lean(count), "name string, gram long, n long")
    counts = materialise(counts.groupBy("name", "gram").agg(F.sum("n").alias("n")), "ngrams")
    best = Window.partitionBy("name").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= profile).orderBy("name", "place")
    out: dict[str, list[int]] = {name: [] for name in sorted(sizes)}
    for r in rows.toLocalIterator():  # ``profile`` rows for each language
        out[r["name"]].append(r["gram"])
    return out


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], ranked: int = RANKED):
        self.names, self.ranked = [n for n in sorted(profiles) if profiles[n]], ranked
        self.most = max([0, *(len(profiles[n]) for n in self.names)])
        self.tables = []
        for n in self.names:
            grams = np.array(profiles[n], np.int64)
            order = np.argsort(grams)
            self.tables.append((grams[order], order))

    def distances(self, text: str) -> np.ndarray | None:
        """The mean out-of-place distance to each profile, as a share of the largest; None without letters."""
        grams, counts = ngrams(text)
        if not len(grams):
            return None
        mine = _ranking(grams, counts, self.ranked)
        place = np.arange(len(mine))
        out = []
        for grams, rank in self.tables:
            at = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
            away = np.where(grams[at] == mine, np.minimum(np.abs(rank[at] - place), self.most), self.most)
            out.append(away.mean() / self.most)
        return np.array(out)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and how much nearer it is than the runner-up as a share of their sum, scaled to 0..1."""
        far = self.distances(text) if text and self.names else None
        if far is None:
            return "und", 0.0
        best = int(np.argmin(far))
        rest = np.delete(far, best)
        second = float(rest.min()) if len(rest) else 1.0
        total = float(far[best]) + second
        return self.names[best], 0.5 if total <= 0 else min(1.0, max(0.0, second / total))


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, lang_pred and score (0.5: as near to another language; 1: exactly the profile) of each document."""
    bound_batches(docs.sparkSession)
    model = Profiles(profiles)

    def run(batches):
        for batch in batches:
            got = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["key", "lang_pred", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lean(run), f"key {docs.schema[key].dataType.simpleString()}, lang_pred string, score double")
