"""Collocations against a plain count, with fingerprints that collide and bitmaps that are full."""

import re
from collections import Counter

import numpy as np
import pytest

from symgrid.llm import phrases


def plain(rows, min_count, top, longest=4):
    """All by dictionaries: lang, rank, phrase, a, l, r, n, score."""
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            found = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            words[lang] += len(found)
            held = counts.setdefault(lang, Counter())
            for size in range(1, longest + 1):
                held.update(tuple(found[i : i + size]) for i in range(len(found) - size + 1))
    result = []
    for lang, held in counts.items():
        candidates = {p: a for p, a in held.items() if len(p) > 1 and a >= min_count}
        scored = []
        for phrase, a in candidates.items():
            cuts = [(2_000_000 * a // (held[phrase[:k]] + held[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            inside = any(
                100 * b >= 80 * a and any(other[i : i + len(phrase)] == phrase for i in range(len(other) - len(phrase) + 1))
                for other, b in candidates.items()
                if len(other) > len(phrase)
            )
            if not inside:
                scored.append((-score, -a, " ".join(phrase).encode(), held[phrase[:k]], held[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(result)


def made(n, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(12)] + ["été", "日本", "X", "\x00"]
    ends = np.array([" ", "  ", "\t", ", ", ".\n", " ", " ", "; "])
    texts = []
    for k in range(n):
        parts = [w + e for w, e in zip(rng.choice(words, 30), rng.choice(ends, 30), strict=True)]
        texts.append("".join(parts) + ("new york city " if k % 3 else "The New York!"))
    return texts


ROWS = [
    *[(n, text, ["en", "de", None, ""][n % 4]) for n, text in enumerate(made(120))],
    (None, None, "en"), (1, "", "en"), (1, "...", "fr"), (2, "one two three four five " * 40, "es"), (2, "one two three four five " * 40, "es"),
    (3, "a" * 50_000 + " b", "en"),
]


def found(docs, rows, **options):
    table = docs([(n, text) if lang == "en" else (n, text, lang) for n, text, lang in rows]).repartition(4)
    return sorted(map(tuple, phrases.collocations(table, **options).collect()))


@pytest.mark.parametrize(("min_count", "top", "bits"), [(30, 2000, 1 << 26), (5, 40, 1 << 20), (3, 2000, 1 << 15)])
def test_collocations_match_plain_counts(docs, min_count, top, bits):
    want = plain([(lang, text) for _, text, lang in ROWS], min_count, top)
    assert found(docs, ROWS, min_count=min_count, top=top, bits=bits) == want
    assert min_count > 8 or any(row[2] == "new york city" for row in want)


def test_full_bitmaps_lose_nothing(docs, monkeypatch):
    """With all bits set everything is counted and spelled out, to the same result."""
    monkeypatch.setattr(phrases, "_bitmap", lambda prints, bits: np.full(bits // 8, 255, np.uint8))
    assert found(docs, ROWS, min_count=8, bits=1 << 15) == plain([(lang, text) for _, text, lang in ROWS], 8, 2000)


def test_colliding_fingerprints_are_told_apart():
    words = phrases.Words("en", [b"a b a b. c d c d"])
    words.hashes = np.full_like(words.hashes, 7)
    numbers = words.numbered()
    assert len(set(numbers.tolist())) == 4 and numbers[0] == numbers[2] != numbers[1]
    places = words.places(2)
    first, counts = words.counted(2, places, np.zeros(len(places), np.uint64), numbers)
    spelled = {tuple(numbers[[p, p + 1]].tolist()): int(n) for p, n in zip(first, counts, strict=True)}
    assert spelled == Counter(tuple(numbers[[p, p + 1]].tolist()) for p in places)


def test_long_counts_are_exact(spark):
    score = "CAST(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV CAST(l + r AS DECIMAL(19,0)) AS BIGINT)"
    a, total = 4_611_686_018_427_387_903, 9_223_372_036_854_775_806
    row = spark.sql(f"SELECT {score} AS s FROM VALUES ({a}L, {total // 2}L, {total - total // 2}L) AS t(a, l, r)").first()
    assert row.s == 2_000_000 * a // total


def test_empty_tables(docs):
    assert phrases.collocations(docs([])).collect() == []
    assert phrases.collocations(docs([(1, None), (2, ""), (3, "...")])).collect() == []
