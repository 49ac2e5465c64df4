"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts are normalised byte by byte (A-Z lower-cased, everything but digits, letters and non-ASCII
bytes a separator), so that a normalised byte stands where its original stood and a hit maps
back to the original text. A window is ``length`` consecutive words of an item; an item of fewer words is one
window. Windows overlap, so the automaton does not spell them all: it holds the items' blocks of half a window, side
by side. Every window has one of them whole; where one is found, the windows around it are looked up
by hash and compared with the item's bytes. Items of fewer words than a window are in the automaton as they are.
Each document is scanned once.

The automaton is built inside the tasks from items that the driver reads from the benchmark in
blocks of about BLOCK_BYTES of text, cutting longer items into overlapping parts. A benchmark beyond one block
takes one pass over the documents per block, each adding to the hits of the one before. A pass is written
to the shared folder before the next block is read, so driver and tasks hold one block at a time.

Defined results: NULL, empty and separator-only texts and items have no words, so no hits; an item with NULL id
marks words but is not listed; rows are scanned one by one, so repeated rows give repeated results; other columns
pass through unread. The result column's name is the caller's choice.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import staged

LENGTH = 10
#: Benchmark text of one automaton, which takes about 60 times as much memory.
BLOCK_BYTES = 4 << 20
SCHEMA = "n_words long, hits array<struct<start:long,end:long,from_char:long,to_char:long>>, items array<long>"

_TABLE = bytearray(b" " * 128 + bytes(range(128, 256)))
for _byte in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TABLE[_byte] = _byte
for _byte in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_byte] = _byte + 32
_TABLE = bytes(_TABLE)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


class Scanner:
    """The automaton with a table of windows, and the scan of one text."""

    def __init__(self, block: list[tuple[int | None, str]], length: int = LENGTH):
        self.length, self.half = length, (length + 1) // 2
        self.automaton = ahocorasick.Automaton()
        #: The longer items one after the other, and of their windows, in the order of their hashes: where, and whose.
        self.items: list[int | None] = []
        texts, hashes, places, owners = [], array("q"), array("q"), array("q")
        short: dict[bytes, set] = {}
        blocks: set[bytes] = set()
        at = 0
        for item, text in block:
            found = normal_words(text)
            if not found:
                continue
            if len(found) < length:
                short.setdefault(b" ".join(found), set()).add(item)
                continue
            blocks.update(b" ".join(found[i : i + self.half]) for i in range(0, len(found) - self.half + 1, self.half))
            for i in range(len(found) - length + 1):
                hashes.append(hash(b" ".join(found[i : i + length])))
                places.append(at)
                owners.append(len(self.items))
                at += len(found[i]) + 1
            at += sum(len(word) + 1 for word in found[len(found) - length + 1 :])
            texts.append(b" ".join(found))
            self.items.append(item)
        self.text = b" ".join(texts)
        order = np.argsort(np.frombuffer(hashes, np.int64), kind="stable")
        self.hashes, self.places, self.owners = (np.frombuffer(a, np.int64)[order] for a in (hashes, places, owners))
        for pattern in blocks.union(short):
            items = short.get(pattern)
            self.automaton.add_word(
                f" {pattern.decode('latin-1')} ",
                (pattern.count(b" ") + 1, pattern in blocks, None if items is None else items - {None}),
            )
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def window_items(self, window: bytes) -> set | None:
        """The items that have this window, or None if none has."""
        key = hash(window)
        at, end = (int(np.searchsorted(self.hashes, key, side)) for side in ("left", "right"))
        same = [k for k in range(at, end) if self.text.startswith(window, self.places[k])]
        return {self.items[self.owners[k]] for k in same} - {None} if same else None

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, runs of hit words, items found."""
        found = normal_words(text)
        if self.empty or not found:
            return len(found), [], set()
        line = f" {b' '.join(found).decode('latin-1')} "
        hits: list[tuple[int, int]] = []
        items: set = set()
        seen = at = looked = 0
        for end, (size, is_block, owners) in self.automaton.iter(line):
            seen += line.count(" ", at, end)
            at = end
            if owners is not None:
                hits.append((seen - size, seen))
                items |= owners
            if is_block:
                for start in range(max(looked, seen - self.length), min(seen - size, len(found) - self.length) + 1):
                    whose = self.window_items(b" ".join(found[start : start + self.length]))
                    if whose is not None:
                        hits.append((start, start + self.length))
                        items |= whose
                looked = max(looked, seen - size + 1)
        return len(found), merge_runs(hits), items


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code point offsets of each normalised word in the original text: start and end."""
    raw = np.frombuffer(text.encode("utf-8", "replace").translate(_TABLE), np.uint8)
    inside = np.concatenate(([False], raw != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return chars[edges[0::2]], chars[edges[1::2]]


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(runs):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def _scan_column(text: Column, earlier: Column, block: list[tuple[int | None, str]], length: int) -> Column:
    @F.pandas_udf(SCHEMA)
    def scan(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(block, length)
        for texts, before in batches:
            rows = []
            for text, hits, items in zip(texts, before["hits"], before["items"], strict=True):
                n, runs, found = scanner.scan(text)
                old = [] if hits is None else [(hit["start"], hit["end"]) for hit in hits]
                found |= set() if items is None else set(items)
                spans = []
                if runs or old:
                    starts, ends = word_places(text)
                    spans = [
                        {"start": a, "end": b, "from_char": int(starts[a]), "to_char": int(ends[b - 1])}
                        for a, b in merge_runs(old + runs)
                    ]
                rows.append((n, spans, sorted(found)))
            yield pd.DataFrame(rows, columns=["n_words", "hits", "items"])

    return scan.asNondeterministic()(text, earlier)


def item_parts(text: str, length: int, part_bytes: int) -> Iterator[str]:
    """A long item in parts that overlap by ``length - 1`` words, so that each window lies whole in one."""
    if len(text) <= part_bytes:
        yield text
        return
    found = normal_words(text)
    step = max(1, part_bytes * len(found) // max(1, len(text)))
    for at in range(0, max(1, len(found) - length + 1), step):
        yield b" ".join(found[at : at + step + length - 1]).decode("utf-8")


def benchmark_blocks(
    benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, length: int = LENGTH
) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, one held by the driver at a time."""
    block, size = [], 0
    for item, text in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        for part in item_parts(text, length, block_bytes):
            if block and size + len(part) > block_bytes:
                yield block
                block, size = [], 0
            block.append((item, part))
            size += len(part)
    yield block


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, column: str = "contamination", length: int = LENGTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with a struct ``column``: words, hit runs (word and original character offsets), items found."""
    nothing = F.lit(None).cast("struct<n_words:long,hits:array<struct<start:long,end:long,from_char:long,to_char:long>>,items:array<long>>")
    marked = docs.withColumn(column, nothing)
    for number, block in enumerate(benchmark_blocks(benchmark, block_bytes, length)):
        if number:
            marked = staged(marked, "contamination")
        marked = marked.withColumn(column, _scan_column(F.col("text"), F.col(column), block, length))
    return marked


def clean_documents(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` without any hit, whole."""
    column = "contamination"
    while column in docs.columns:
        column += "_"
    marked = mark_contamination(docs, benchmark, column, length)
    return marked.where(F.size(F.col(f"{column}.hits")) <= 0).drop(column)


SQL = f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), {LENGTH}) AS n, array_to_string(ws[i : i + {LENGTH - 1}], ' ') AS w
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {LENGTH - 2}, 2))) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
found AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows USING (n, w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
