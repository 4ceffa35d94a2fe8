"""The linear-chain field's decoding and marginals against all labellings of short pages."""

import itertools
import random

import numpy as np
import pytest

from strandgraph.llm import html_crf


def score(field, unary, labels):
    return sum(u for u, y in zip(unary, labels) if y) + sum(field.step[a, b] for a, b in itertools.pairwise(labels))


@pytest.mark.parametrize("seed", range(30))
def test_viterbi_and_marginals_equal_all_labellings(seed):
    rng = random.Random(seed)
    field = html_crf.Crf()
    field.step = np.array([[rng.gauss(0, 2) for _ in range(2)] for _ in range(2)])
    unary = [rng.gauss(0, 3) for _ in range(rng.randint(1, 9))]
    every = list(itertools.product((0, 1), repeat=len(unary)))
    scores = np.array([score(field, unary, y) for y in every])
    assert tuple(field.viterbi(unary)) == every[int(scores.argmax())]
    p = np.exp(scores - np.logaddexp.reduce(scores))
    each, pairs = field.marginals(unary)
    assert np.allclose(each, np.array(every).T @ p)
    for a, b in itertools.product((0, 1), repeat=2):
        assert np.isclose(pairs[a, b], sum(q * sum(x == (a, b) for x in itertools.pairwise(y)) for q, y in zip(p, every)))


def test_viterbi_of_no_block_and_of_ties():
    field = html_crf.Crf()
    field.step = np.zeros((2, 2))
    assert field.viterbi([]) == [] and field.viterbi([0.0, 0.0]) == [0, 0]


def test_labels_of_real_features_are_the_best_of_all_labellings():
    field = html_crf.model()
    page = "<body><nav><a href=x>Home</a><a href=y>About</a></nav><article><h1>A title of some length</h1><p>One sentence of prose, long enough to count as text. And a second one follows it.</p><p>Another paragraph, which says more about the same thing.</p></article><footer>Copyright 2024</footer></body>"
    blocks = html_crf.blocks(page)
    unary = field.unary(html_crf.features(blocks))
    every = list(itertools.product((0, 1), repeat=len(unary)))
    best = max(every, key=lambda y: score(field, unary, y))
    assert tuple(field.label(blocks)) == best and 4 <= len(blocks) <= 9 and sum(best) >= 2
