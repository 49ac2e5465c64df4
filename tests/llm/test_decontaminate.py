"""Decontamination against brute force, in one block of items and in several."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from symgrid.llm import decontaminate as d

WORDS = st.lists(st.sampled_from(["a", "B", "c", "é", "1", "ab", " x"]), max_size=40)
GLUE = st.sampled_from([" ", ", ", "\n", "-", "._"])


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, length):
    words = words_of(text)
    hit, found = set(), set()
    for item, other in items:
        theirs = words_of(other)
        size = min(length, len(theirs))
        for i in range(len(theirs) - size + 1 if theirs else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == theirs[i : i + size]:
                    hit |= set(range(j, j + size))
                    found.add(item)
    return len(words), hit, found


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS, max_size=5), WORDS, GLUE, st.integers(1, 4))
def test_scan(items, text, glue, length):
    items = [(i, " ".join(words)) for i, words in enumerate(items)]
    text = glue.join(text)
    n, runs, found = d.Scanner(items, length).scan(text)
    want = brute(text, items, length)
    assert (n, {p for a, b in d.merge_runs(runs) for p in range(a, b)}, found) == want


@settings(max_examples=100, deadline=None)
@given(WORDS, WORDS, st.integers(1, 4), st.integers(1, 30))
def test_parts_of_a_long_item(item, text, length, part_bytes):
    item, text = " ".join(item), " ".join(text)
    n, runs, found = d.Scanner([(1, part) for part in d.item_parts(item, length, part_bytes)], length).scan(text)
    assert (n, {p for a, b in d.merge_runs(runs) for p in range(a, b)}, found) == brute(text, [(1, item)], length)


def test_memory_of_the_automaton():
    rng = random.Random(2)
    text = " ".join(f"{rng.randrange(20_000):x}word" for _ in range(25_000))
    scanner = d.Scanner([(1, text)])
    assert scanner.automaton.get_stats()["total_size"] < 60 * len(text)


def test_blocks_offsets_and_defined_results(spark, docs):
    passage = "One two THREE four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(7, passage), (8, "zwölf, Katzen"), (None, "only this"), (9, None), (10, "..")], "item_id long, text string")
    texts = [(1, f"é {passage.lower().replace(' ', ' - ')}!"), (2, None), (3, ""), (4, "so zwölf KATZEN"), (5, "only this"), (5, "only this"), (6, "one two three")]
    for block in (1, 1 << 20):
        found = d.mark_contamination(docs(texts), items, "found", block_bytes=block).select("doc_id", "text", "found").collect()
        by = {r.doc_id: r for r in found}
        assert len(found) == 7
        hit = by[1].found.hits[0]
        assert by[1].text[hit.from_char : hit.to_char] == passage.lower().replace(" ", " - ")
        assert (hit.start, hit.end, by[1].found["items"]) == (1, 12, [7])
        assert by[4].found["items"] == [8] and by[5].found["items"] == [] and len(by[5].found.hits) == 1
        assert not by[2].found.hits and not by[3].found.hits and not by[6].found.hits
    clean = d.clean_documents(docs(texts), items)
    assert clean.columns == docs(texts).columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 6]
    assert d.mark_contamination(docs([]), items, "found").count() == 0
    assert d.clean_documents(docs(texts), items.where(F.lit(False))).count() == 7
