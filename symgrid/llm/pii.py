"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one scan: at-signs, schemes, plus signs, digit pairs
and identifier cues. A small parser for each anchor expands from there to the boundaries of an address,
number or account, and validates what it finds (Luhn for cards, remainder 97 for IBANs, part sizes for
IP addresses). All boundary characters are ASCII, so the scan runs over the UTF-8 bytes;
offsets are given in code points, end exclusive.

Kinds, in this order: email, ip, card, phone (leftmost and non-overlapping within a kind), then
url, iban and account (an account or social security number after a cue).

Defined results: NULL and empty texts have no spans; rows are scanned one by one, so repeated
rows give repeated results; other columns pass through unread; the result column's name is the caller's choice. A
text is scanned whole, and its time grows with its length: each parser reads a run of characters once.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
SCHEMA = "array<struct<kind:string,start:long,end:long>>"

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
_ALNUM = _LETTERS | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_SCHEME = _ALNUM | frozenset("+.-")
_URL = _ALNUM | frozenset("-._~:/?#[]@!$&'()*+,;=%")
#: Cues before account numbers, and what may stand between cue and number.
ACCOUNT_CUES = ("account", "acct", "ssn", "passport", "konto", "compte", "cuenta")
_BETWEEN = frozenset(" :#.=-") | _LETTERS
_REACH = 24


def _right(line: str, at: int, allowed: frozenset) -> int:
    while at < len(line) and line[at] in allowed:
        at += 1
    return at


def _left(line: str, at: int, allowed: frozenset, stop: int) -> int:
    while at > stop and line[at - 1] in allowed:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _email(line: str, at: int, stop: int) -> tuple[int, int] | None:
    start = _left(line, at, _LOCAL, stop)
    end = _right(line, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    domain = end
    while domain + 1 < len(line) and line[domain] == "." and line[domain + 1] in _LABEL:
        domain = _right(line, domain + 1, _LABEL)
    return (start, domain) if domain > end else None


def _addresses(line: str, at: int) -> tuple[int, list[tuple[int, int]]]:
    """End of the dotted run of numbers around ``at``, and the addresses in it: four parts after four."""
    start = at
    while start and (line[start - 1] in _DIGITS or line[start - 1] == "." and start > 1 and line[start - 2] in _DIGITS):
        start -= 1
    parts = []
    end = start
    while True:
        stop = _right(line, end, _DIGITS)
        parts.append((end, stop))
        end = stop
        if end + 1 < len(line) and line[end] == "." and line[end + 1] in _DIGITS:
            end += 1
        else:
            break
    found = []
    for first in range(0, len(parts) - 3, 4):
        four = parts[first : first + 4]
        values = [line[a:b].lstrip("0") or "0" for a, b in four]
        if all(len(value) < 4 and int(value) < 256 for value in values):
            found.append((four[0][0], four[3][1]))
    return end, found


def _card(line: str, at: int) -> tuple[int, tuple[int, int] | None]:
    """End of the run of digits with single blanks or hyphens around ``at``, and the run if it is a card number."""
    start = at
    while start and (line[start - 1] in _DIGITS or line[start - 1] in " -" and start > 1 and line[start - 2] in _DIGITS):
        start -= 1
    end = at + 1
    while end < len(line) and (line[end] in _DIGITS or line[end] in " -" and end + 1 < len(line) and line[end + 1] in _DIGITS):
        end += 1
    digits = line[start:end].replace(" ", "").replace("-", "")
    return end, (start, end) if 16 <= len(digits) <= 19 and luhn(digits) else None


def _phone(line: str, at: int) -> tuple[int, int] | None:
    if at + 1 >= len(line) or line[at + 1] not in _DIGITS:
        return None
    end = _right(line, at + 1, _PHONE)
    while line[end - 1] not in _DIGITS:
        end -= 1
    digits = sum(character in _DIGITS for character in line[at:end])
    return (at, end) if end - at >= 4 and 8 <= digits <= 15 else None


def _url(line: str, at: int, stop: int) -> tuple[int, int] | None:
    start = _left(line, at, _SCHEME, stop)
    while start < at and line[start] not in _LETTERS:
        start += 1
    end = _right(line, at + 3, _URL)
    while end > at + 3 and line[end - 1] in ".,;:!?)]'":
        end -= 1
    return (start, end) if start < at and end > at + 3 else None


def _iban(line: str, at: int) -> tuple[int, int] | None:
    start = at
    while start < len(line) and start < at + 4 and line[start] in " :":
        start += 1
    end, code = start, ""
    while end < len(line) and len(code) < 34 and (line[end] in _ALNUM or line[end] == " " and code):
        code += line[end].strip()
        end += 1
        if 15 <= len(code) and code[:2].isalpha() and code[2:4].isdigit():
            moved = code[4:] + code[:4]
            if int("".join(str(int(character, 36)) for character in moved)) % 97 == 1:
                if end == len(line) or line[end] not in _ALNUM:
                    return start, end
    return None


def _account(line: str, at: int) -> tuple[int, int] | None:
    start = at
    while start < len(line) and start < at + _REACH and line[start] in _BETWEEN:
        start += 1
    if start >= len(line) or line[start] not in _DIGITS:
        return None
    end = start
    while end < len(line) and (line[end] in _DIGITS or line[end] in " -" and end + 1 < len(line) and line[end + 1] in _DIGITS):
        end += 1
    return (start, end) if 6 <= sum(character in _DIGITS for character in line[start:end]) <= 18 else None


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign, kind in (("@", "email"), ("://", "url"), ("+", "phone"), ("iban", "iban")):
        found.add_word(sign, (kind, len(sign)))
    for cue in ACCOUNT_CUES:
        found.add_word(cue, ("account", len(cue)))
    for a in "0123456789":
        found.add_word(f"{a}.", ("ip", 2))
        for b in "0123456789":
            for between in ("", " ", "-"):
                found.add_word(f"{a}{between}{b}", ("card", 2 + len(between)))
    found.make_automaton()
    return found


def find_spans(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by kind in the order of KINDS, then by start."""
    if not text:
        return []
    raw = text.encode("utf-8", "replace")
    line = raw.lower().decode("latin-1")
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in automaton.iter(line):
        at = last - size + 1
        if kind == "card" or kind == "ip":
            if at < done[kind]:
                continue
            if kind == "card":
                done[kind], card = _card(line, at)
                found = [card] if card else []
            else:
                done[kind], found = _addresses(line, at)
        else:
            if kind == "email":
                span = _email(line, at, done[kind])
            elif kind == "url":
                span = _url(line, at, done[kind])
            elif kind == "phone":
                span = _phone(line, at)
            elif kind == "iban":
                span = _iban(line, last + 1)
            else:
                span = _account(line, last + 1)
            found = [span] if span and span[0] >= done[kind] else []
            if found:
                done[kind] = found[0][1]
        spans[kind] += found
    if len(raw) == len(text) or not any(spans.values()):
        return [(kind, a, b) for kind in KINDS for a, b in spans[kind]]
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [(kind, int(chars[a]), int(chars[b])) for kind in KINDS for a, b in spans[kind]]


def personal_spans(text: Column) -> Column:
    """All spans of each text, in the order of KINDS, then by start."""

    @F.pandas_udf(SCHEMA)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = anchors()
        for texts in batches:
            yield pd.Series(
                [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(text, automaton)] for text in texts],
                dtype=object,
            )

    return scan.asNondeterministic()(text)
