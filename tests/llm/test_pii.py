"""Personal data: the base kinds against their patterns, and what the method adds."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from symgrid.llm import pii


@pytest.fixture(scope="module")
def automaton():
    return pii.anchors()


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number))]
    return sum(doubled) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda t: 16 <= len(digits(t)) <= 19 and luhn(digits(t))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 8 <= len(digits(t)) <= 15),
}


def brute(text):
    return [(kind, m.start(), m.end()) for kind, (pattern, ok) in BASE.items() for m in re.finditer(pattern, text) if ok(m.group())]


def check(text, automaton):
    assert [s for s in pii.find_spans(text, automaton) if s[0] in BASE] == brute(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aZ@..-+ 019%()é", max_size=40))
def test_base_kinds_on_noise(automaton, text):
    check(text, automaton)


PARTS = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "10.0.0.255", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "+1 (743) 555-3824",
         "a.b@c.example.com", "x@y@z.org", "é", " ", "@", ".", "+49", "-", "007", "Kİ", "0" * 30]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=8).map("".join))
def test_base_kinds_on_parts(automaton, text):
    check(text, automaton)


def test_added_kinds(automaton):
    text = "ü see https://example.com/a?b=c. IBAN: GB82 WEST 1234 5698 7654 32, account no: 123-456-789; iban XX00 1234"
    spans = [(kind, text[a:b]) for kind, a, b in pii.find_spans(text, automaton)]
    assert ("url", "https://example.com/a?b=c") in spans
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in spans
    assert ("account", "123-456-789") in spans
    assert sum(kind == "iban" for kind, _ in spans) == 1


def test_defined_results(docs, automaton):
    rows = [(1, None), (2, ""), (3, "ä a@b.co"), (3, "ä a@b.co"), (4, "1" * 200_000 + " +1 234 567 89 " + "b" * 200_000)]
    found = docs(rows).withColumn("found", pii.personal_spans(F.col("text"))).select("doc_id", "found").collect()
    assert [len(r.found) for r in sorted(found, key=lambda r: r.doc_id)] == [0, 0, 1, 1, 1]
    assert next(r.found[0] for r in found if r.doc_id == 3).asDict() == {"kind": "email", "start": 2, "end": 8}
    assert docs([]).select(pii.personal_spans(F.col("text"))).collect() == []
