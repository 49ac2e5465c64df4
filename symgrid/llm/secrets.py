"""Secret scan by token efficiency.

Three plain patterns find assignments, access keys and long hexadecimal strings. Beyond those, a
run of key characters is a secret of kind ``token`` if a byte-level BPE vocabulary needs many tokens for it, for one of its
parts between / = _ and -, or for any SHORTEST characters of it, so a readable prefix hides no key: words and
names of a language compress to several characters per token, random strings do not. What has letters without digits
must stay below a stricter ratio; what has no letters is left alone, as are known digests (hexadecimal strings of digest lengths), UUIDs and
parts of addresses. The span is the whole run.

Spans are in code points, end exclusive, by start and then kind. NULL and empty texts have none; rows are scanned one by
one, so repeated rows give repeated results; other columns pass through unread; texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.llm.packing import byte_bpe

KINDS = ("assign", "access", "hex", "token")
SCHEMA = "array<struct<kind:string,start:long,end:long>>"
#: Characters per token below which a run counts as random, and the shortest run that is tested.
RATIO = 2.0
#: The same for letters without digits, which words are.
LETTERS_RATIO = 1.9
SHORTEST = 20
#: Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
PLACEHOLDER = "[SECRET]"

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEXADECIMAL = re.compile(r"[0-9A-Fa-f]+")
_HAS_BOTH = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])")
_SEPARATORS = re.compile(r"[/=_-]+")
#: A UUID or a digest that is a part of a run, or several.
#: Digests of the parts of web pages, in base 64.
_INTEGRITY = re.compile(r"sha256-[A-Za-z0-9+/]{43}=|sha384-[A-Za-z0-9+/]{64}|sha512-[A-Za-z0-9+/]{86}==")
_KNOWN = re.compile(rf"(?<![A-Za-z0-9+])(?:{_UUID.pattern}|{'|'.join(f'[0-9A-Fa-f]{{{n}}}' for n in DIGESTS)})(?![A-Za-z0-9+])")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, place in KINDS, end."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return spans + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def _needs_many(stretch: str, encoding) -> bool:
    if _HAS_BOTH.match(stretch):
        return len(stretch) < RATIO * len(encoding.encode_ordinary(stretch))
    return stretch.isalpha() and len(stretch) < LETTERS_RATIO * len(encoding.encode_ordinary(stretch))


def is_random(run: str, encoding) -> bool:
    """Whether a run is neither a known kind of identifier nor made of parts that the vocabulary knows."""
    if _UUID.fullmatch(run) or _INTEGRITY.fullmatch(run):
        return False
    if _HEXADECIMAL.fullmatch(run) and len(run) in DIGESTS:
        return False
    if _needs_many(run, encoding):
        return True
    for rest in _KNOWN.split(run):
        for part in _SEPARATORS.split(rest):
            if len(part) >= SHORTEST and _needs_many(part, encoding):
                return True
        if any(_needs_many(rest[i : i + SHORTEST], encoding) for i in range(len(rest) - SHORTEST + 1)):
            return True
    return False


def find_spans(text: str | None, encoding) -> list[tuple[str, int, int]]:
    if not text:
        return []
    spans = base_spans(text)
    for m in _RUN.finditer(text):
        # The slashes before the host of a URL are no part of what stands in it.
        start = m.start() + 2 * text.startswith("://", m.start() - 1)
        if m.end() - start >= SHORTEST and "@" not in text[max(0, start - 3) : start] and is_random(text[start : m.end()], encoding):
            spans.append((start, 3, m.end()))
    return [(KINDS[kind], start, end) for start, kind, end in sorted(spans)]


def secret_spans(text: Column, vocabulary: str = "byte_bpe_50k.tiktoken") -> Column:
    """All spans of each text, by start, then kind."""

    @F.pandas_udf(SCHEMA)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = byte_bpe(vocabulary)
        for texts in batches:
            yield pd.Series(
                [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(text, encoding)] for text in texts],
                dtype=object,
            )

    return scan.asNondeterministic()(text)


def redact(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by PLACEHOLDER, and ``n_chars``, if there is one, as it then is."""
    spans = "spans"
    while spans in docs.columns:
        spans += "_"
    found = docs.withColumn(spans, secret_spans(F.col("text"), vocabulary))
    changed = F.size(spans) > 0
    clean = found.withColumn("text", without_spans(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.drop(spans)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` with each maximal run of spans replaced by PLACEHOLDER; spans come sorted by start."""
    step = F.aggregate(
        spans,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda state, span: F.when(span.end <= state.at, state)
        .when(
            span.start < state.at,
            F.struct(state.done.alias("done"), span.end.alias("at")),
        )
        .otherwise(
            F.struct(
                F.concat(
                    state.done,
                    F.substring(text, (state.at + 1).cast("int"), (span.start - state.at).cast("int")),
                    F.lit(PLACEHOLDER),
                ).alias("done"),
                span.end.alias("at"),
            )
        ),
        lambda state: F.concat(state.done, F.substring(text, (state.at + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, step).otherwise(text)
