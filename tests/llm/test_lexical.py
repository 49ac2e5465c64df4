"""Ranked search against a plain evaluation, and the graph of shared sums by itself."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from symgrid.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(folded)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aZ9 _.@[`{\x7f\x80Éİ日\n"), st.characters(codec="utf-8")), max_size=50))
def test_terms(text):
    assert [term.decode() for term in lexical.terms_of(text)] == plain_terms(text)


def plain_search(docs, items, top):
    held = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    held = [(doc_id, counts) for doc_id, counts in held if counts]
    number, terms = len(held), sum(sum(counts.values()) for _, counts in held)
    frequency = Counter(term for _, counts in held for term in counts)
    rows = []
    for item_id, text in items:
        found = []
        for doc_id, counts in held:
            m = 75 + 25 * sum(counts.values()) * number // terms
            score = sum(
                lexical.term_weight(number, frequency[t]) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in plain_terms(text)
                if counts[t]
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:top], 1)]
    return rows


def in_order(rows):
    return sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, row[1], row[3], row[2] is None, row[2] or 0))


DOCS = [
    (1, "the cat sat on the mat"), (2, "The CAT"), (3, None), (4, ""), (5, "... --- !"), (7, "the cat"), (6, "the cat"),
    (6, "the cat"), (None, "the cat"), (8, "a dog ran " * 4000), (9, "Ünïcode wörds, cat"), (10, "x" * 30_000), (11, "dog cat mat hat"),
]
ITEMS = [(1, "the cat"), (2, "the the cat dog"), (3, None), (4, ""), (5, "unknown words"), (6, "wörds x cat mat hat"), (6, "dog"),
         (7, "x" * 30_000), (8, "cat mat hat")]


@pytest.mark.parametrize("block_terms", [1 << 16, 4])
def test_search_matches_plain_evaluation(spark, docs, block_terms):
    items = spark.createDataFrame([(*row, 0, 0) for row in ITEMS], "item_id long, text string, score long, rank int")
    found = lexical.search(docs(DOCS).repartition(4), items, 4, block_terms).select("item_id", "rank", "doc_id", "score")
    assert in_order(map(tuple, found.collect())) == in_order(plain_search(DOCS, ITEMS, 4))


def test_large_random_collection(spark, docs):
    rng = np.random.default_rng(5)
    words = [f"w{n}" for n in range(60)]
    texts = [(n, " ".join(rng.choice(words, rng.integers(1, 40)))) for n in range(1500)]
    queries = [(n, " ".join(rng.choice(words, rng.integers(1, 15)))) for n in range(40)]
    items = spark.createDataFrame(queries, "item_id long, text string")
    found = lexical.search(docs(texts).repartition(6), items, 20)
    assert in_order(map(tuple, found.collect())) == in_order(plain_search(texts, queries, 20))


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs([]), items).collect() == []
    assert lexical.search(docs(DOCS), items.limit(0)).collect() == []
    assert lexical.search(docs([(1, None)]), items).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 12), st.integers(1, 3), max_size=9), min_size=1, max_size=12))
def test_shared_sums_are_the_queries(queries):
    values = np.random.default_rng(1).integers(0, 1 << 40, (13, 5))
    want = [sum((times * values[term] for term, times in query.items()), np.zeros(5, np.int64)) for query in queries]
    assert np.array_equal(lexical.share(queries).scores(values), np.array(want))


def test_shared_sets_are_summed_once():
    shared = {term: 1 for term in range(10)}
    sums = lexical.share([{**shared, 20 + n: 1} for n in range(8)])
    additions = sum(map(len, sums.levels)) + len(sums.parts) - len(sums.filled)
    assert additions == 9 + 8
    assert len(lexical.share([{1: 1, 2: 1}, {3: 1, 4: 1}]).levels) == 0
