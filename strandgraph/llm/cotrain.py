"""Document quality by co-training two views.

View one sees only the text (byte rates, word and line statistics).  View two sees only the metadata: source,
language and length of the row, and host, path and query of the page that the document came from, where one
is known.  Each view is a logistic regression, fitted first on the labelled documents.  In each round every
unlabelled document that one view is sure of becomes a pseudo-label of the other view, which takes bounded Newton
steps on the true and on all of these labels; the pseudo-labels of a class weigh together as ``TRUST`` of the true
ones do.  The sums that a step needs (counts, gradients, curvatures) are added up on the executors over the whole corpus; the
driver gets a few arrays of fixed size.  Both views are then calibrated on labelled documents that neither was
trained on, and a logistic regression over the two calibrated log odds, fitted on a further part of them, scores
every document.

The labelled documents that the driver fits on are at most about ``labelled``, drawn by a hash of the key; no
other row is sampled or capped.

Edge cases: a null or empty text has zero rates; null metadata is a value of its own; without labels of both
kinds every document scores 0.5 and is kept; rows that repeat a key are scored alike if their columns are
equal; a null key has no labels and no page, and is scored; a key with several labels counts as the lowest;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import NOT_SPACE, word_hashes, words
from .common import bound_batches, lean, materialise, pieces, sized, utf8_buffers

#: Labelled rows that the driver fits on, in expectation; rounds of exchange and steps in each; the log odds beyond
#: the prior that a view must be sure by; the weight of all handed-over labels beside the true ones.
LABELLED, ROUNDS, STEPS, SURE, TRUST = 10_000, 2, 2, 2.0, 0.2
_META = 96
_HOST_WORD = re.compile(r"[a-z0-9]+")


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rates of each ASCII byte and of others, and statistics of words and lines; a row for each document."""
    n = len(offsets) - 1
    size = np.maximum(1, np.diff(offsets))
    doc = np.repeat(np.arange(n), np.diff(offsets))
    rates = np.bincount(doc * 129 + np.minimum(data, 128), minlength=n * 129).reshape(n, 129) / size[:, None]
    upper, lower = rates[:, 65:91].sum(axis=1), rates[:, 97:123].sum(axis=1)
    starts, ends, owner = words(data, offsets, NOT_SPACE)
    h = word_hashes(data, starts, ends, NOT_SPACE)
    count = np.bincount(owner, minlength=n)
    many = np.maximum(1, count)
    length = np.bincount(owner, ends - starts, minlength=n) / many
    long = np.bincount(owner, (ends - starts) > 20, minlength=n) / many
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner, same, minlength=n) / many
    order = np.lexsort((h, owner))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    variety = np.bincount(owner[order][new], minlength=n) / many
    lines = np.bincount(doc[data == 10], minlength=n) + 1
    stats = [upper, upper / np.maximum(lower + upper, 1e-9), np.log1p(count) / 5, length / 10, long, again, variety, np.log1p(count / lines) / 5, variety < 0.2, again > 0.2]
    return np.column_stack([np.log1p(1000 * rates) / 4, *stats]).astype(np.float32)


def meta_features(source: str | None, lang: str | None, n_chars: int | None, url: str | None) -> np.ndarray:
    """Hashed indicators of the row's and its page's metadata, and the length."""
    out = np.zeros(_META + 3, np.float32)

    def set_(name: str):
        out[zlib.crc32(name.encode("utf-8", "replace")) % _META] = 1

    set_(f"source={source}")
    set_(f"lang={lang}")
    out[_META] = np.log1p(max(0, n_chars or 0)) / 10
    out[_META + 1] = n_chars is None
    out[_META + 2] = url is not None
    if url is not None:
        scheme, _, rest = url.partition("://")
        host, _, path = rest.partition("/")
        set_(f"scheme={scheme}")
        for w in _HOST_WORD.findall(host.lower()):
            set_(f"host={w}")
        set_(f"depth={path.count('/')}")
        for mark in ("?", "#", ".html", "utm_"):
            if mark in path:
                set_(f"mark={mark}")
    return out


class Logistic:
    """Ridge logistic regression by Newton steps on standardised columns."""

    def __init__(self, ridge: float = 1.0):
        self.ridge = ridge

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 12) -> Logistic:
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = self.columns(x)
        self.penalty = np.full(z.shape[1], self.ridge)
        self.penalty[-1] = 1e-6
        self.beta = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            gradient = z.T @ (y - p) - self.penalty * self.beta
            hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(self.penalty)
            self.beta = self.beta + np.linalg.solve(hessian, gradient)
        return self

    def columns(self, x: np.ndarray) -> np.ndarray:
        """The standardised columns and a constant one."""
        return np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.beta[:-1] + self.beta[-1], -30, 30)


def sigmoid(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


class CoTrained:
    """The two fitted views, their calibration and the combination."""

    def __init__(self, views: list[np.ndarray], label: np.ndarray):
        """views: a row for each labelled document.  Of four, two train, one calibrates and one combines."""
        part = np.arange(len(label)) % 4
        self.ready = all(len(np.unique(label[at])) == 2 for at in (part < 2, part == 2, part == 3))
        self.exchanged = 0
        if not self.ready:
            return
        self.label = label
        self.true = [x[part < 2].astype(np.float64) for x in views]
        self.true_label = label[part < 2]
        self.rest = [[x[part == k] for x in views] for k in (2, 3)], [label[part == k] for k in (2, 3)]
        self.models = [Logistic().fit(x, self.true_label) for x in self.true]

    def sums(self, teachers: list[Logistic], views: list[np.ndarray]) -> np.ndarray:
        """For each view and class the count, gradient and curvature over what the other view is sure of."""
        out = []
        share = self.true_label.mean()
        for v in (0, 1):
            evidence = teachers[1 - v].log_odds(views[1 - v]) - np.log(share / (1 - share))  # beyond what the labels' share says
            z = self.models[v].columns(views[v])
            p = sigmoid(np.clip(z @ self.models[v].beta, -30, 30))
            for y, sure in ((0, evidence < -SURE), (1, evidence > SURE)):
                zs = z[sure]
                out += [[float(len(zs))], zs.T @ (y - p[sure]), (zs.T @ zs / 4).reshape(-1)]
        return np.concatenate(out)

    def step(self, sums: np.ndarray) -> None:
        """A step of both views on the true labels and the pseudo-labels that ``sums`` adds up.  The curvature is its
        upper bound (a quarter of the squares), so every step raises the likelihood."""
        at, share, self.exchanged = 0, self.true_label.mean(), 0
        for v in (0, 1):
            m = self.models[v]
            z = m.columns(self.true[v])
            d = z.shape[1]
            p = sigmoid(np.clip(z @ m.beta, -30, 30))
            gradient = z.T @ (self.true_label - p) - m.penalty * m.beta
            hessian = z.T @ z / 4 + np.diag(m.penalty)
            for part in (1 - share, share):
                n, g, h = sums[at], sums[at + 1 : at + 1 + d], sums[at + 1 + d : at + 1 + d + d * d]
                at += 1 + d + d * d
                if n:
                    weight = TRUST * len(z) * part / n
                    gradient += weight * g
                    hessian += weight * h.reshape(d, d)
                    self.exchanged += int(n)
            m.beta = m.beta + np.linalg.solve(hessian, gradient)

    def finish(self) -> None:
        """Calibrates both views, then combines them."""
        (fit, mix), (fit_y, mix_y) = self.rest
        self.platt = [Logistic(0.1).fit(self.models[v].log_odds(fit[v])[:, None], fit_y) for v in (0, 1)]
        self.final = Logistic().fit(np.column_stack([self.odds(v, mix[v]) for v in (0, 1)]), mix_y)
        del self.true, self.true_label, self.rest, self.label

    def odds(self, v: int, x: np.ndarray) -> np.ndarray:
        return self.platt[v].log_odds(self.models[v].log_odds(x)[:, None])

    def score(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the text view, the metadata view and both."""
        if not self.ready:
            return (np.full(len(views[0]), 0.5),) * 3
        odds = [self.odds(v, views[v]) for v in (0, 1)]
        return sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(self.final.log_odds(np.column_stack(odds)))


def page_urls(pages: DataFrame) -> DataFrame:
    """page_key, url: the smallest URL of each document that has a page; a page names its document last in its path."""
    key = F.regexp_extract(F.regexp_extract("url", "^[^?#]*", 0), "/(\\d{1,18})(?:\\.\\w+)?/?$", 1)
    return pages.select(F.when(key != "", key.cast("long")).alias("page_key"), "url").where("page_key IS NOT NULL").groupBy("page_key").agg(F.min("url").alias("url"))


_TEXT = text_features(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape[1]


def unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The two views of the columns x and m."""
    x, m = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(-1, width).astype(np.float64) for c, kind, width in (("x", "<f2", _TEXT), ("m", "<f4", _META + 3)))
    return [x, m]


def features(docs: DataFrame, labels: DataFrame, pages: DataFrame, text: str = "text", key: str = "doc_id", target: str = "quality") -> DataFrame:
    """doc_id, label (null: none) and both views of every document, written once and read by every later pass."""
    bound_batches(docs.sparkSession)
    urls = materialise(page_urls(pages), "page-urls")
    known = materialise(labels.where(F.col(target).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("label_key")).agg(F.min(F.col(target).cast("int")).alias("label")), "labels")
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"), F.col(text).alias("text"))

    def seen(batches):
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(4))
            for i, j in pieces(offsets):
                x = text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).astype("<f2")
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in batch.columns[:4]], pa.array([r.tobytes() for r in x], pa.binary())], ["k", "source", "lang", "n_chars", "x"])

    def met(batches):
        for batch in batches:
            m = [meta_features(*r).astype("<f4").tobytes() for r in zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars", "url")))]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("label"), batch.column("x"), pa.array(m, pa.binary())], ["doc_id", "label", "x", "m"])

    narrow = rows.mapInArrow(lean(seen), "k long, source string, lang string, n_chars long, x binary")
    # no page or label has a negative key, so rows without a key spread over many that match nothing
    spread = narrow.withColumn("at", F.coalesce(F.col("k"), -1 - F.pmod(F.xxhash64("x"), F.lit(1 << 20))))
    joined = spread.join(sized(urls, 4 * urls.count()), (F.col("at") == F.col("page_key")) & F.col("k").isNotNull(), "left")
    joined = joined.join(sized(known, known.count()), (F.col("at") == F.col("label_key")) & F.col("k").isNotNull(), "left")
    return materialise(joined.select("k", "source", "lang", "n_chars", "url", "label", "x").mapInArrow(lean(met), "doc_id long, label int, x binary, m binary"), "views")


def _total(seen: DataFrame, model: CoTrained, teachers: list[Logistic]) -> np.ndarray:
    """The sums of all unlabelled documents: one array a task, those added in a few tasks, then on the driver."""

    def add(batches):
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                total = total + model.sums(teachers, unpacked(batch))
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def merge(batches):
        total = 0.0
        for batch in batches:
            for one in batch.column(0).to_pylist():
                total = total + np.frombuffer(one)
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    each = seen.where("label IS NULL").select("x", "m").mapInArrow(lean(add), "sums binary")
    few = each.repartition(8).mapInArrow(merge, "sums binary").collect()  # at most eight arrays
    return np.sum([np.frombuffer(r["sums"]) for r in few], axis=0)


def train(seen: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, steps: int = STEPS) -> CoTrained:
    """Fits on ``features``."""
    known = seen.where("label IS NOT NULL")
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("co-training")), F.lit(1 << 20))
    share = min(1.0, labelled / max(1, known.count()))
    rows = known.where(draw < share * (1 << 20)).select("doc_id", "label", "x", "m").toArrow()  # bounded by ``labelled``
    order = sorted(range(rows.num_rows), key=lambda i: (zlib.crc32(str(rows["doc_id"][i].as_py()).encode()), rows["x"][i].as_py(), rows["m"][i].as_py()))
    rows = rows.take(pa.array(order, pa.int64())).combine_chunks()
    views = unpacked(rows) if rows.num_rows else [np.zeros((0, 1))] * 2
    model = CoTrained(views, np.array(rows["label"].to_pylist(), np.int64))
    if model.ready:
        for _ in range(rounds):
            teachers = [copy(m) for m in model.models]
            for _ in range(steps):
                total = _total(seen, model, teachers)
                if total.ndim == 0:  # no unlabelled document
                    break
                model.step(total)
        model.finish()
    return model


def score(seen: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """doc_id, both views' calibrated probabilities, the combined score and whether the document is kept."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                text, meta, both = model.score(unpacked(batch))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text), pa.array(meta), pa.array(both), pa.array(both >= threshold, pa.bool_())], ["doc_id", "p_text", "p_meta", "score", "kept"])

    return seen.select("doc_id", "x", "m").mapInArrow(lean(run), "doc_id long, p_text double, p_meta double, score double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, pages: DataFrame, text: str = "text", key: str = "doc_id", target: str = "quality") -> DataFrame:
    """``score`` of every document by a model trained on them."""
    seen = features(docs, labels, pages, text, key, target)
    return score(seen, train(seen))
