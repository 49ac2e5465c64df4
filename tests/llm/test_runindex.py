"""Repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
import zstandard

from symgrid.llm import runindex


def brute(rows):
    first = {}
    texts = [(i, (text or "").encode()) for i, text in rows]
    big = 1 << 62
    for i, raw in texts:
        for at in range(len(raw) - 49):
            key = raw[at : at + 50]
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, raw in texts:
        gone = bytearray(len(raw))
        for at in range(len(raw) - 49):
            if first[raw[at : at + 50]] < (big if i is None else i):
                gone[at : at + 50] = b"\1" * 50
        runs = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out.append((-1 if i is None else i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [noise(rng.randrange(50, 130)) for _ in range(5)]
    rows = [(i, noise(rng.randrange(0, 90)) + rng.choice(passages)[rng.randrange(6) :] + noise(rng.randrange(0, 60))) for i in range(70)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(25)]
    rows += [(200, "x" * 300), (201, "x" * 120), (202, "y" + "x" * 49), (203, None), (204, ""), (205, passages[0] * 3)]
    rows += [(206, passages[1]), (206, passages[1]), (None, passages[2]), (None, passages[2])]
    edge = noise(50)
    rows += [(300, edge), (301, edge), (302, edge[:49]), (303, "q" + edge)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("hot", [4096, 3])
def test_marks(docs, monkeypatch, seed, hot):
    monkeypatch.setattr(runindex, "HOT", hot)
    monkeypatch.setattr(runindex, "PACK", 3000)
    monkeypatch.setattr(runindex, "BLOCK", 2000)
    monkeypatch.setattr(runindex, "BUCKET_ANCHORS", 150)
    rows = corpus(seed)
    found = runindex.repeated_passages(docs(rows)).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == brute(rows)
    for r in found:
        assert sum(span.end - span.start for span in r.removed) == r.n_removed


def test_index_of_repetitive_strings():
    rng = random.Random(0)
    base = bytes(rng.choices(b"ab\x00\xff", k=300))
    strings = sorted({base[k : k + rng.randrange(50, 85)] for k in range(200)})
    owners = np.array(rng.sample(range(1000), len(strings)))
    index = runindex.RunIndex(strings, owners)
    assert len(index.run_starts) < sum(map(len, strings)) // 4
    sizes = np.array([len(s) for s in strings])
    least = {}
    for s, owner in zip(strings, owners, strict=True):
        for at in range(len(s) - 49):
            least[s[at : at + 50]] = min(least.get(s[at : at + 50], 9999), owner)
    want = [least[s[at : at + 50]] for s in strings for at in range(len(s) - 49)]
    assert index.least_owners(sizes).tolist() == want


def packed(texts):
    sizes = np.array([len(text) for text in texts])
    return runindex.Pack(np.arange(len(texts)), sizes, np.frombuffer(b"".join(texts), np.uint8))


def test_contexts_of_a_string_that_one_document_repeats():
    rng = random.Random(3)
    noise = lambda n: bytes(rng.choices(range(97, 123), k=n))
    mark = noise(40)
    repeating = b"".join(mark + noise(24) for _ in range(500))
    pack = packed([repeating, noise(40) + mark + noise(40), repeating])
    unique, docs, place = pack.distinct()
    asked = pack.questions(np.ones(len(unique), np.uint8), place)
    want = np.unique(asked["keys"], return_counts=True)[1]
    counts = pack.contexts(place)
    often = np.bincount(place) >= runindex.OFTEN
    assert often.any() and (counts[often] == want[often]).all() and (counts >= want).all()
    assert counts.max() > 100 and docs.max() <= 3


def test_buckets_get_equal_shares_of_anchors():
    pack = packed([bytes(random.Random(4).choices(range(97, 123), k=200_000))])
    unique, _, place = pack.distinct()
    asked = pack.questions(np.ones(len(unique), np.uint8), place)
    for keys in (unique, asked["keys"]):
        shares = [end - start for _, start, end in runindex._bounds(keys, 20)]
        assert len(shares) == 20 and max(shares) < 1.5 * len(keys) / 20


def test_anchors_are_kept_with_their_pack():
    rng = random.Random(5)
    noise = lambda n: bytes(rng.choices(b"ab ", k=n))
    texts = [noise(rng.randrange(0, 200)) for _ in range(60)] + [b"x" * 300, b"xy" * 90, b"", b"z" * 49]
    pack = packed(texts)
    row = pd.Series({
        "doc_ids": pack.doc_ids.tobytes(), "lengths": np.array([len(text) for text in texts]).tobytes(),
        "data": zstandard.compress(b"".join(texts)), "anchors": pack.found_anchors(),
    })
    again = runindex.Pack.of(row)
    grams = lambda s: [bytes(pack.data[k : k + runindex.GRAM]) for k in range(s, s + runindex.LENGTH - runindex.GRAM + 1)]
    owned = {int(s) for a, b in zip(pack.first, pack.last, strict=True) for s in range(a, b + 1)}
    assert owned == {s + k for s, e in zip(pack.starts, pack.ends, strict=True) for k in range(e - s - 49)}
    for at, first, last in zip(pack.anchors, pack.first, pack.last, strict=True):
        gram = bytes(pack.data[at : at + runindex.GRAM])
        assert first <= last and all(gram in grams(s) for s in range(first, last + 1))
    for name in ("anchors", "first", "last", "hashes"):
        assert (getattr(again, name) == getattr(pack, name)).all(), name


@pytest.mark.parametrize(("contexts", "state"), [([2000, 2000], 1), ([2000, 2096], 2)])
def test_anchors_of_many_contexts_are_split(contexts, state):
    hashes = np.array([7, 9], np.uint64)
    one = np.ones(2, np.uint8)
    content = [runindex._squeeze(hashes, one, np.array([n, 4096], np.uint16)) for n in contexts]
    alone = runindex._squeeze(np.array([11], np.uint64), one[:1], np.array([4096], np.uint16))
    letters = pd.DataFrame({"pack": [0, 1, 2], "content": [*content, alone]})
    answers = [runindex._unsqueeze(x)[0].tolist() for x in runindex._answer_anchors((0,), letters)["content"]]
    assert answers == [[state, 2], [state, 2], [0]]


def test_packs_are_not_moved(spark, docs, monkeypatch):
    monkeypatch.setattr(runindex, "PACK", 3000)
    monkeypatch.setattr(runindex, "PART", 6000, raising=False)
    tables = [table.name for table in spark.catalog.listTables()]
    found = runindex.repeated_passages(docs(corpus(0)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(pack") == plan.count("Exchange") == 1
    assert found.count() == len(corpus(0))
    assert [table.name for table in spark.catalog.listTables()] == tables


def test_empty_table(docs):
    assert runindex.repeated_passages(docs([])).collect() == []
