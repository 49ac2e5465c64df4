"""Lattice scores against sums over all cuts, base scores against plain counts."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from symgrid.llm import lattice

pytest.importorskip("public_tokenizers")
VOCABULARY = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces(VOCABULARY)


def cuts(raw, known):
    if not raw:
        yield []
    for size in range(1, len(raw) + 1):
        if raw[:size] in known:
            for rest in cuts(raw[size:], known):
                yield [known[raw[:size]], *rest]


@pytest.mark.parametrize("word", ["the", "a", "ñandú", "zqx", "\u0001€", "token"])
def test_probability_is_the_sum_over_all_cuts(pieces, word):
    logs = pieces.weights()
    known = {piece: i for i, piece in enumerate(pieces.pieces)}
    counts = np.zeros(pieces.end + 1)
    got = pieces.cut([word, "of", word], logs, counts, np.array([2.0, 0.0, 1.0]))
    every = list(cuts((lattice.MARK + word).encode(), known))
    weights = [math.exp(sum(logs[i] for i in cut)) for cut in every]
    assert math.isclose(got[0], math.log(sum(weights)), rel_tol=1e-9) and got[0] == got[2]
    expected = Counter()
    for cut, weight in zip(every, weights, strict=True):
        for i in cut:
            expected[i] += 3 * weight / sum(weights)
    for i, n in expected.items():
        assert math.isclose(counts[i], n, rel_tol=1e-6, abs_tol=1e-9)


def test_scores_of_a_small_corpus(docs):
    rows = [(i, f"The cat {i % 7} sat on the {'mat' * (i % 3)} rare{i}") for i in range(40)]
    rows += [(50, None), (51, ""), (52, "THE cat unseenword"), (52, "THE cat unseenword"), (None, "the cat")]
    training = F.col("doc_id") < 30
    found = lattice.score_texts(docs(rows), training, VOCABULARY).collect()
    assert len(found) == len(rows)
    counts = Counter()
    for doc_id, text in rows[:30]:
        counts.update(text.encode().lower().split())
        counts[b""] += 1
    n, v = counts.total(), len(counts)
    for r in found:
        text = dict(rows)[r.doc_id]
        tokens = (text or "").encode().lower().split() + [b""]
        assert r.train_tokens == n and r.n_tokens == len(tokens)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens), rel_tol=1e-9)
        assert r.score < 0
    by = {r.doc_id: r.score for r in found}
    assert by[50] == by[51] and by[52] < by[None]
    assert lattice.score_texts(docs([]), training, VOCABULARY).collect() == []
    none = lattice.score_texts(docs(rows[:3]), F.lit(False), VOCABULARY).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in none)


def test_rare_words_take_the_join(docs, monkeypatch):
    rows = [(i, f"the the cat w{i % 5} v{i}") for i in range(30)]
    whole = sorted(map(tuple, lattice.score_texts(docs(rows), F.lit(True), VOCABULARY).collect()))
    monkeypatch.setattr(lattice, "SHARE", 3)
    monkeypatch.setattr(lattice, "HELD", 4)
    again = sorted(map(tuple, lattice.score_texts(docs(rows), F.lit(True), VOCABULARY).collect()))
    assert np.allclose(np.array(whole, float), np.array(again, float))
