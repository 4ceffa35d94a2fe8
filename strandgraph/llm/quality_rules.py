"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0).  Documents fall into vote patterns (at most 3**rules of
them), so expectation-maximisation runs over pattern counts that don't grow with the corpus; it estimates
how often each rule gives each vote on good and on bad documents, and the share of good ones.  The posterior
probability that a document is good replaces the all-must-pass filter.

Edge cases: null and empty texts have no words, fail the base rule and aren't kept; an empty table gives an
empty result; repeated rows each give a row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialise

_SPACES = "[ \\t-\\r]+"
_SYMBOLS = "#*$%&|<>"


def _repeated(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more: candidates by a 32-bit hash, then compared as text."""
    high = lambda x: F.shiftright(x, 32)
    gram = lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))
    keyed = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.shiftleft(F.hash(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).cast("long"), 32).bitwiseOR(i.cast("long")))

    def alike(s, key):
        return F.filter(s, lambda x, i: (key(x) == key(F.get(s, i - 1))) | (key(x) == key(F.get(s, i + 1))))

    def covered(at):
        steps = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def exact(found):
        named = F.transform(found, lambda x: F.struct(gram(x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).alias("g"), x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("i")))
        return let(F.sort_array(named), lambda s: let(F.sort_array(F.transform(alike(s, lambda x: x["g"]), lambda x: x["i"])), covered))

    body = let(F.sort_array(keyed), lambda s: let(alike(s, high), lambda found: F.when(F.size(found) > 0, exact(found)).otherwise(0)))
    return F.when(F.size(w) >= 3, body).otherwise(0).cast("long")


def measures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document with the counts that the rules use."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def per_words(w):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            _repeated(w).alias("n_repeat_words"),
        )

    def per_lines(x):
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda s: s.rlike("[.!?\"'»”:][ \\t-\\r]*$"))).cast("long").alias("n_ended_lines"),
        )

    counted = docs.select(
        F.col(key).alias("doc_id"),
        let(F.array_remove(F.split(whole, _SPACES), ""), per_words).alias("w"),
        let(F.filter(F.split(whole, "\n"), lambda s: s.rlike("[^ \\t-\\r]")), per_lines).alias("l"),
        F.length(whole).cast("long").alias("n_chars"),
        (F.length(whole) - F.length(F.translate(whole, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(whole) - F.length(F.translate(whole, "!", ""))).cast("long").alias("n_shouts"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "\\p{Lu}+", ""))).cast("long").alias("n_upper"),
    )
    return counted.select("doc_id", "w.*", "l.*", "n_symbols", "n_shouts", "n_upper", "n_chars")


def _vote(good: Column | None, bad: Column) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def rules() -> dict[str, Column]:
    """The production rules over ``measures``.  Most only know junk and abstain otherwise; three also know prose."""
    words, ratio = F.col("n_words"), lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "length": _vote(words >= 100, words < 50),
        "symbols": _vote(None, ratio("n_symbols", "n_words") > 0.2),
        "dup_lines": _vote(None, (ratio("n_dup_lines", "n_lines") > 0.3) & (F.col("n_dup_lines") >= 3)),
        "repeats": _vote(None, ratio("n_repeat_words", "n_words") > 0.4),
        "word_length": _vote(None, ~ratio("word_chars", "n_words").between(2, 14)),
        "capitals": _vote(None, ratio("n_upper", "word_chars") > 0.4),
        "shouting": _vote(None, ratio("n_shouts", "n_words") > 0.3),
        "endings": _vote(ratio("n_ended_lines", "n_lines") >= 0.6, (ratio("n_ended_lines", "n_lines") < 0.1) & (F.col("n_lines") >= 5)),
        "variety": _vote((ratio("n_distinct", "n_words") > 0.3) & (words >= 50), (ratio("n_distinct", "n_words") < 0.12) & (words >= 50)),
    }


def _log_odds(votes: Column, names: list[str], model: dict) -> Column:
    """ln P(good | votes) / P(bad | votes); a rule that abstains says nothing of a document.  The weights are an array
    literal, so they don't change the code that Spark compiles."""
    weights = [math.log(model["votes"][n][v][0] / model["votes"][n][v][1]) if v else 0.0 for n in names for v in (-1, 0, 1)]
    weights = F.array(*[F.lit(x) for x in weights])
    each = F.transform(votes, lambda v, i: F.get(weights, i * 3 + v + 1))
    return F.aggregate(each, F.lit(math.log(model["prior"] / (1 - model["prior"]))), lambda a, x: a + x)


#: Where the rounds start: how often a rule votes -1, 0 and 1 on good and on bad documents.
_START = ((0.05, 0.3), (0.35, 0.4), (0.6, 0.3))


def fit(votes: DataFrame, names: list[str], false_alarms: float = 0.1, smooth: float = 1.0) -> dict:
    """EM over the patterns of the array column ``votes``, until a round no longer raises the likelihood.

    The share of good documents is free between 0 and 1 and starts at a half.  Which class is the good one, and what
    rules that hardly disagree can't tell, is settled by one bound on the rates: a rule votes bad on at most the share
    ``false_alarms`` of the good documents.  Each round takes the best rates within it, so where the true rates keep to
    it the estimates are those of plain maximum likelihood.  ``smooth`` votes are spread over a rule's three outcomes,
    whatever the corpus, which keeps every rate inside (0, 1), also for an empty table.

    The driver gets a count for each pattern, at most 3**rules of them, whatever the corpus."""
    counts = sorted((tuple(r["votes"]), r["count"]) for r in votes.groupBy("votes").count().collect())
    seen = np.array([v for v, _ in counts], int).reshape(len(counts), len(names)) + 1
    n = np.array([c for _, c in counts], float)
    is_vote = seen[:, :, None] == np.arange(3)  # pattern, rule, vote
    prior, rates, before = 0.5, np.tile(np.array(_START), (len(names), 1, 1)), -math.inf
    while True:
        logs = np.einsum("prv,rvk->pk", is_vote, np.log(rates)) + np.log([prior, 1 - prior])
        whole = np.logaddexp(logs[:, 0], logs[:, 1])
        likelihood = float(n @ whole)
        if likelihood - before <= 1e-10 * abs(likelihood):
            break
        before = likelihood
        share = np.exp(logs - whole[:, None]) * n[:, None]
        total = share.sum(0)
        rates = (np.einsum("prv,pk->rvk", is_vote, share) + smooth / 3) / (total + smooth)
        over = rates[:, 0, 0] > false_alarms
        rates[over, 1:, 0] *= ((1 - false_alarms) / (1 - rates[over, 0, 0]))[:, None]
        rates[over, 0, 0] = false_alarms
        prior = float((total[0] + smooth / 2) / (total.sum() + smooth))
    return {"prior": prior, "votes": {name: {v: tuple(map(float, rates[i, v + 1])) for v in (-1, 1)} for i, name in enumerate(names)}}


#: Share of good documents that a production rule may call bad.
FALSE_ALARMS = 0.01


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """Measures, votes (in the order of ``rules``), posterior and verdict of each document."""
    named = rules()
    measured = materialise(measures(docs, text, key), "quality-measures")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = measured.select("*", F.array(*named.values()).alias("votes"), base.alias("base_failed"))
    model = fit(voted.where(~F.col("base_failed")).select("votes"), list(named), FALSE_ALARMS)  # the base rule has decided the others
    scored = voted.select("*", (1 / (1 + F.exp(-_log_odds(F.col("votes"), list(named), model)))).alias("quality"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
