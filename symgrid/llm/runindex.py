"""Repeated passages, by a run-length index over the places where texts may repeat.

Every byte covered by a LENGTH-byte string that also starts in a document with a smaller id is
marked, exactly. The work is cut into steps that each move little:

1. Texts are bundled into packs of about PACK bytes, compressed, with their anchors: in every window of LENGTH
   bytes the GRAM-byte gram of least hash is one, so equal windows have equal anchors. Packs are written once, by number, and
   replies come to where they lie, so texts are not moved. How many parts they are written in goes by the bytes of all texts, counted first.
2. Each pack sends the hashes of its anchors once to the bucket of their hash, which answers which of them other
   documents have too. Least hashes are small ones, so buckets go by a second hash, of which they get equal shares.
3. For those, a pack sends the context (the windows that an anchor is least in) with the smallest document that has it. Where all
   contexts of an anchor are equal, the smallest document is the answer for all its windows. Where they differ,
   they repeat each other in part: a block of such contexts is indexed by a run-compressed
   Burrows-Wheeler transform with the suffix array sampled at run ends, every context is streamed through
   it from right to left, and the rows it passes give the matches of LENGTH bytes and more with the
   smallest document of each.
4. Each pack marks its windows and gives one row per document.

An anchor of HOT contexts or more, each counted once per pack, is split: its windows go to the buckets of their own hashes, one by
one. So a block is never larger than BLOCK and HOT contexts of one anchor, even if a document repeats it many thousand times. A pack sends an anchor, context or window once however many of its documents have it. Buckets are as many as the corpus needs to
keep each within a bounded size. Hashes choose what is compared; contexts and windows are told apart by
64 more bits.

Defined results: NULL and empty texts have no bytes; a NULL ``doc_id`` counts as larger than all others; rows that
share a ``doc_id`` don't mark each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import staged, staged_by
from symgrid.llm.shingles import mix

LENGTH = 50
GRAM = 16
PACK = 1 << 20
HOT = 4096
#: An anchor with as many occurrences in a pack has its different contexts counted; below, every occurrence counts as one.
OFTEN = 8
#: Anchors in a bucket, about, and bytes of an indexed block.
BUCKET_ANCHORS = 1 << 19
BLOCK = 1 << 18
#: Buckets that a task answers, on average.
AT_ONCE = 2
#: Bytes of text in a part of the packs, about, and as many parts at most: Spark allows 100,000.
PART = 16 * PACK
MOST_PARTS = 1 << 16

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_NONE = np.iinfo(np.int64).max

PACKS = "pack long, doc_ids binary, lengths binary, data binary, anchors binary"
LETTERS = "bucket long, pack long, content binary"
REPLIES = "pack long, step int, bucket long, content binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"


_held_powers: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """Powers of ``base`` from 0 on; those for packs of usual size are computed once in a process."""
    held = _held_powers.get(base)
    if held is not None and len(held) >= count:
        return held[:count]
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    powers = np.cumprod(steps, dtype=np.uint64)
    if count <= 2 * PACK:
        _held_powers[base] = powers
    return powers


def _squeeze(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed value. The bytes of numbers are regrouped by place, which sorted numbers gain from."""
    parts = []
    for array in arrays:
        if isinstance(array, bytes):
            kind, size, raw = b"b", len(array), array
        else:
            kind, size = array.dtype.char.encode(), len(array)
            raw = array.view(np.uint8).reshape(size, -1).T.tobytes() if size else b""
        parts += [kind, size.to_bytes(8, "little"), len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unsqueeze(value: bytes) -> list:
    raw = zstandard.ZstdDecompressor().decompress(value)
    found, at = [], 0
    while at < len(raw):
        kind = raw[at : at + 1].decode()
        size, length = (int.from_bytes(raw[at + k : at + k + 8], "little") for k in (1, 9))
        body, at = raw[at + 17 : at + 17 + length], at + 17 + length
        if kind == "b":
            found.append(body)
        elif size:
            planes = np.frombuffer(body, np.uint8).reshape(-1, size)
            found.append(np.ascontiguousarray(planes.T).view(np.dtype(kind)).reshape(-1))
        else:
            found.append(np.zeros(0, np.dtype(kind)))
    return found


def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest value of every ``width`` neighbours, by running ones from both ends of blocks."""
    ufunc = np.minimum if least else np.maximum
    rows = np.concatenate((values, np.full(-len(values) % width, values[-1]))).reshape(-1, width)
    ahead = ufunc.accumulate(rows, axis=1).ravel()[width - 1 : len(values)]
    back = rows[:, ::-1]
    ufunc.accumulate(back, axis=1, out=back)
    return ufunc(rows.ravel()[: len(ahead)], ahead, out=ahead)


class Pack:
    """The texts of a pack in a row, and their anchors with the first and last window that each is least in."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, data: np.ndarray, anchors: list[np.ndarray] | None = None):
        self.doc_ids, self.data = doc_ids, data
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        n = len(data)
        self.inverse = _powers(_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _powers(_BASE, n), dtype=np.uint64, out=self.sums[1:])
        self.anchors, self.first, self.last = self._found(lengths) if anchors is None else anchors
        at = self.anchors
        grams = mix((self.sums[at + GRAM] - self.sums[at]) * self.inverse[at]) | _U(1)
        # The least of many hashes are small ones, which would fill the first buckets: anchors go by a hash of the hash.
        self.hashes = mix(grams ^ _U(0x3C3C3C3C3C3C3C3C))

    def _found(self, lengths: np.ndarray) -> list[np.ndarray]:
        width = LENGTH - GRAM + 1
        n = len(self.data)
        if n < LENGTH:
            return [np.zeros(0, np.int64)] * 3
        grams = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * self.inverse[: n - GRAM + 1]) | _U(1)
        inside = np.zeros(n + 1, np.int32)
        long = lengths >= LENGTH
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, self.ends[long] - LENGTH + 1, -1)
        inside = np.cumsum(inside)[: n - LENGTH + 1] > 0
        least = _slide(grams, width, True) * inside
        edge = np.zeros(width - 1, np.uint64)
        anchors = np.flatnonzero(_slide(np.concatenate((edge, least, edge)), width, False) == grams)
        # The windows that an anchor is least in are side by side: those with it in the first run of its hash.
        runs = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        values, ends = least[runs], np.append(runs[1:], len(least)) - 1
        hashes = grams[anchors]
        run = np.searchsorted(runs, np.maximum(anchors - width + 1, 0), side="right") - 1
        behind = np.flatnonzero(values[run] != hashes)
        while len(behind):
            run[behind] += 1
            behind = behind[values[run[behind]] != hashes[behind]]
        return [anchors, np.maximum(runs[run], anchors - width + 1), np.minimum(ends[run], anchors)]

    @classmethod
    def of(cls, row) -> Pack:
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.data), np.uint8)
        gaps, before, after = _unsqueeze(row.anchors)
        anchors = np.cumsum(gaps, dtype=np.int64)
        found = [anchors, anchors - before, anchors - after]
        return cls(np.frombuffer(row.doc_ids, np.int64), np.frombuffer(row.lengths, np.int64), data, found)

    def found_anchors(self) -> bytes:
        """The anchors as ``of`` reads them: gaps, and how far before them their first and last windows start."""
        gaps = np.diff(self.anchors, prepend=0).astype(np.uint32)
        return _squeeze(gaps, (self.anchors - self.first).astype(np.uint8), (self.anchors - self.last).astype(np.uint8))

    def docs_of(self, places: np.ndarray) -> np.ndarray:
        """Index of the document at each place."""
        return np.searchsorted(self.ends, places, side="right")

    def places(self) -> np.ndarray:
        """Of each anchor its hash's place among the distinct ones."""
        return np.unique(self.hashes, return_inverse=True)[1]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, sorted; in how many documents each is; of each anchor its hash's place among them."""
        unique, place = np.unique(self.hashes, return_inverse=True)
        # Anchors stand in the order of their documents, so a stable sort by hash keeps those of a document together.
        order = np.argsort(place, kind="stable")
        docs = self.docs_of(self.anchors)[order]
        first = np.ones(len(order), bool)
        first[1:] = (place[order[1:]] != place[order[:-1]]) | (docs[1:] != docs[:-1])
        return unique, np.bincount(place[order[first]], minlength=len(unique)), place

    def contexts(self, place: np.ndarray) -> np.ndarray:
        """Of each distinct hash how many contexts it has, at most its occurrences."""
        counts = np.bincount(place)
        often = counts >= OFTEN
        if often.any():
            asked = self.questions(often.astype(np.uint8), place)
            counts[often] = np.unique(asked["keys"], return_counts=True)[1]
        return counts

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def entries(self, state: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows to ask about: of each the first and last start, the key, and what tells contexts of a key apart.

        A shared anchor (state 1) asks for all windows it is least in at once, a hot one (state 2) for each alone.
        """
        wanted = state[place]
        chosen = wanted > 0
        hashes, hot = self.hashes[chosen], wanted[chosen] == 2
        first, last = self.first[chosen], self.last[chosen]
        whole = ~hot
        counts = (last - first + 1)[hot]
        each = _ranges(first[hot], counts)
        lows, highs = np.concatenate((first[whole], each)), np.concatenate((last[whole], each))
        marks = self.span_hash(lows, highs + LENGTH)
        single = np.concatenate((np.zeros(whole.sum(), bool), np.ones(len(each), bool)))
        keys = np.concatenate((hashes[whole], mix(marks[whole.sum() :] ^ _U(0xA5A5A5A5A5A5A5A5))))
        return lows, highs, keys, marks, single

    def questions(self, state: np.ndarray, place: np.ndarray) -> dict:
        """Entries with the same key and context asked once, sorted by key, with the smallest document that has it."""
        lows, highs, keys, marks, single = self.entries(state, place)
        docs = self.doc_ids[self.docs_of(lows)]
        order = np.lexsort((docs, marks, keys))
        new = np.ones(len(order), bool)
        new[1:] = (keys[order[1:]] != keys[order[:-1]]) | (marks[order[1:]] != marks[order[:-1]])
        asked = order[new]
        question = np.zeros(len(order), np.int64)
        question[order] = np.cumsum(new) - 1
        return {"lows": lows, "highs": highs, "question": question, "asked": asked, "keys": keys[asked],
                "marks": marks[asked], "docs": docs[asked], "single": single[asked]}


def _bounds(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Bucket, and the range of sorted keys in it, of the buckets that have any."""
    numbers = ((keys >> _U(32)) * _U(buckets)) >> _U(32)
    found, starts = np.unique(numbers, return_index=True)
    for bucket, start, end in zip(found, starts, [*starts[1:], len(keys)], strict=True):
        yield int(bucket), int(start), int(end)


def packs_of(docs: DataFrame) -> DataFrame:
    """Documents in packs, in the order of reading."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []
        size = 0

        def row() -> pd.DataFrame:
            data = b"".join(text for _, text in held)
            ids = np.array([doc_id for doc_id, _ in held], np.int64).tobytes()
            lengths = np.array([len(text) for _, text in held], np.int64).tobytes()
            packed = zstandard.ZstdCompressor(level=3).compress(data)
            anchors = Pack(np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64), np.frombuffer(data, np.uint8)).found_anchors()
            columns = ["pack", "doc_ids", "lengths", "data", "anchors"]
            return pd.DataFrame([(number, ids, lengths, packed, anchors)], columns=columns)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("object"), batch["text"], strict=True):
                held.append((_NONE if pd.isna(doc_id) else int(doc_id), (text or "").encode("utf-8", "replace")))
                size += len(held[-1][1])
                if size >= PACK:
                    yield row()
                    number, held, size = number + 1, [], 0
        if held:
            yield row()

    return docs.select("doc_id", "text").mapInPandas(run, PACKS)


def _by_bucket(letters: DataFrame, buckets: int):
    """Letters grouped by bucket, in as many tasks as the buckets need, so that what a task reads does not grow with the corpus."""
    return letters.repartition(1 + buckets // AT_ONCE, "bucket").groupBy("bucket")


def _send_anchors(packs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                pack = Pack.of(row)
                unique, docs, place = pack.distinct()
                docs = np.minimum(docs, 2).astype(np.uint8)
                contexts = np.minimum(pack.contexts(place), HOT).astype(np.uint16)
                rows = [(b, row.pack, _squeeze(unique[s:e], docs[s:e], contexts[s:e])) for b, s, e in _bounds(unique, buckets)]
                yield pd.DataFrame(rows, columns=["bucket", "pack", "content"])

    return packs.mapInPandas(run, LETTERS)


def _answer_anchors(key: tuple, letters: pd.DataFrame) -> pd.DataFrame:
    """For each pack the state of its anchors in this bucket: 0 in one document alone, 1 shared, 2 hot."""
    opened = [_unsqueeze(content) for content in letters["content"]]
    hashes = np.concatenate([x[0] for x in opened])
    unique, place = np.unique(hashes, return_inverse=True)
    docs, contexts = (np.bincount(place, np.concatenate([x[k] for x in opened])) for k in (1, 2))
    state = np.where(docs < 2, 0, np.where(contexts < HOT, 1, 2)).astype(np.uint8)[place]
    pieces = np.split(state, np.cumsum([len(x[0]) for x in opened])[:-1])
    rows = [(pack, 1, key[0], _squeeze(piece)) for pack, piece in zip(letters["pack"], pieces, strict=True)]
    return pd.DataFrame(rows, columns=["pack", "step", "bucket", "content"])


def _states(replies: pd.DataFrame) -> np.ndarray:
    first = replies[replies["step"] == 1].sort_values("bucket")
    return np.concatenate([np.zeros(0, np.uint8), *(_unsqueeze(content)[0] for content in first["content"])])


def _ask(buckets: int):
    def ask(packs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in packs.itertuples():
            pack = Pack.of(row)
            asked = pack.questions(_states(replies), pack.places())
            for bucket, s, e in _bounds(asked["keys"], buckets):
                chosen = asked["asked"][s:e]
                lows, highs = asked["lows"][chosen], asked["highs"][chosen]
                sizes = np.where(asked["single"][s:e], 0, highs - lows + LENGTH)
                texts = b"".join(pack.data[a : a + n].tobytes() for a, n in zip(lows, sizes, strict=True))
                content = _squeeze(asked["keys"][s:e], asked["marks"][s:e], asked["docs"][s:e], sizes.astype(np.uint16), texts)
                rows.append((bucket, row.pack, content))
        return pd.DataFrame(rows, columns=["bucket", "pack", "content"])

    return ask


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a block of strings, with what streaming a string through it needs."""

    def __init__(self, strings: list[bytes], owners: np.ndarray):
        sizes = np.array([len(string) for string in strings])
        self.last = np.cumsum(sizes + 1) - 1
        joined = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        symbols = joined.astype(np.int64) + 1
        symbols[self.last] = 0
        n = len(symbols)
        rank = self._first_ranks(symbols)
        tied = self._refine(rank, np.arange(n), 7)
        at_21, depth = rank.copy(), 21
        while len(tied):
            tied, depth = self._refine(rank, tied, depth), 3 * depth
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)
        before = np.where(self.order > 0, symbols[self.order - 1], -1)
        self.run_starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        heads = before[self.run_starts]
        run_ends = np.append(self.run_starts[1:], n)
        self.run_of = np.repeat(np.arange(len(heads)), run_ends - self.run_starts)
        self.samples = self.order[run_ends - 1]
        by_head = np.argsort(heads, kind="stable")
        lengths = (run_ends - self.run_starts)[by_head]
        # Runs of a symbol map to rows one after another. The block's start has no symbol before it; its place stands for
        # the block's last separator, which no row has before it.
        self.targets = np.empty(len(heads), np.int64)
        self.targets[by_head] = np.cumsum(lengths) - lengths
        self.separator_rows = rank[self.last]
        # Rows with LENGTH symbols in common are side by side, and three ranks of 21 symbols tell whether two have.
        at_21 = np.concatenate((at_21 + 1, np.zeros(LENGTH - 21, np.int64)))
        new = np.zeros(n, bool)
        new[:1] = True
        for ahead in (0, 21, LENGTH - 21):
            part = at_21[self.order + ahead]
            new[1:] |= part[1:] != part[:-1]
        self.group_of = np.cumsum(new) - 1
        owner = np.repeat(owners, sizes + 1)
        self.group_least = np.minimum.reduceat(owner[self.order], np.flatnonzero(new))
        del self.order

    @staticmethod
    def _first_ranks(symbols: np.ndarray) -> np.ndarray:
        padded = np.concatenate((symbols, np.zeros(6, np.int64)))
        key = np.zeros(len(symbols), np.int64)
        for k in range(7):
            key = key << 9 | padded[k : k + len(symbols)]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        return (np.cumsum(counts) - counts)[inverse]

    @staticmethod
    def _refine(rank: np.ndarray, tied: np.ndarray, depth: int) -> np.ndarray:
        """Make the ranks of tied strings those of strings three times as deep, and tell which are still tied.

        A rank is the number of strings before it and its equals. Three ranks fit 63 bits: a block has less than a million symbols.
        """
        n = len(rank)
        after = np.concatenate((rank + 1, np.zeros(2 * depth, np.int64)))
        keys = ((after[tied] - 1) * (n + 1) + after[tied + depth]) * (n + 1) + after[tied + 2 * depth]
        order = np.argsort(keys)
        keys, tied = keys[order], tied[order]
        before, new, at = rank[tied], np.ones(len(tied), bool), np.arange(len(tied))
        new[1:] = before[1:] != before[:-1]
        place = before + at - np.maximum.accumulate(np.where(new, at, 0))
        new[1:] = keys[1:] != keys[:-1]
        rank[tied] = np.maximum.accumulate(np.where(new, place, 0))
        return tied[~(new & np.append(new[1:], True))]

    def step(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the strings one symbol longer to the left."""
        run = self.run_of[rows]
        return self.targets[run] + rows - self.run_starts[run]

    def least_owners(self, sizes: np.ndarray) -> np.ndarray:
        """For every window of each string, from left to right, the smallest owner of a string that has it; one after another."""
        windows = np.maximum(0, sizes - LENGTH + 1)
        found = np.zeros(windows.sum(), np.int64)
        after = np.cumsum(windows) + LENGTH - 1  # the window that ends with a string is the last of its own
        live, rows = np.arange(len(sizes)), self.separator_rows
        for matched in range(1, int(sizes.max(initial=0)) + 1):
            keep = sizes[live] >= matched
            live, rows = live[keep], self.step(rows[keep])
            if matched >= LENGTH:
                found[after[live] - matched] = self.group_least[self.group_of[rows]]
        return found


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def _answer_contexts(key: tuple, letters: pd.DataFrame) -> pd.DataFrame:
    """For each pack's questions in this bucket: the smallest document, for all windows of a context or for each."""
    opened = [_unsqueeze(content) for content in letters["content"]]
    keys, marks, docs, sizes = (np.concatenate([x[k] for x in opened]) for k in range(4))
    texts = b"".join(x.pop() for x in opened)
    ends = np.cumsum(sizes.astype(np.int64))
    order = np.lexsort((docs, marks, keys))
    new_key, new_mark = np.ones(len(order), bool), np.ones(len(order), bool)
    new_key[1:] = keys[order[1:]] != keys[order[:-1]]
    new_mark[1:] = new_key[1:] | (marks[order[1:]] != marks[order[:-1]])
    contexts = order[new_mark]
    context = np.zeros(len(order), np.int64)
    context[order] = np.cumsum(new_mark) - 1
    key_of = np.cumsum(new_key)[new_mark] - 1
    least = docs[contexts]
    several = np.flatnonzero(np.bincount(key_of)[key_of] > 1)
    counts = np.ones(len(contexts), np.int64)
    counts[several] = sizes[contexts[several]].astype(np.int64) - LENGTH + 1
    offsets = np.cumsum(counts) - counts
    values = np.zeros(counts.sum(), np.int64)
    values[offsets] = least
    start = 0
    while start < len(several):
        # A block ends where a key ends, once it is large enough.
        stop, size = start, 0
        while stop < len(several) and (size < BLOCK or key_of[several[stop]] == key_of[several[stop - 1]]):
            size += int(sizes[contexts[several[stop]]]) + 1
            stop += 1
        chosen = several[start:stop]
        lengths = sizes[contexts[chosen]].astype(np.int64)
        strings = [texts[end - length : end] for end, length in zip(ends[contexts[chosen]], lengths, strict=True)]
        values[_ranges(offsets[chosen], counts[chosen])] = RunIndex(strings, least[chosen]).least_owners(lengths)
        start = stop
    rows, at = [], 0
    for pack, x in zip(letters["pack"], opened, strict=True):
        own = context[at : at + len(x[0])]
        at += len(x[0])
        given = values[_ranges(offsets[own], counts[own])]
        rows.append((pack, 2, key[0], _squeeze(counts[own].astype(np.uint16), given)))
    return pd.DataFrame(rows, columns=["pack", "step", "bucket", "content"])


def _mark(packs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for row in packs.itertuples():
        pack = Pack.of(row)
        asked = pack.questions(_states(replies), pack.places())
        opened = [_unsqueeze(x) for x in replies[replies["step"] == 2].sort_values("bucket")["content"]]
        started = np.zeros(len(pack.data) + 1, np.int8)
        if opened:
            counts = np.concatenate([x[0] for x in opened]).astype(np.int64)
            values = np.concatenate([x[1] for x in opened])
            offsets = np.cumsum(counts) - counts
            lows, highs, question = asked["lows"], asked["highs"], asked["question"]
            widths = highs - lows + 1
            starts = _ranges(lows, widths)
            within = starts - np.repeat(lows, widths)
            asks = np.repeat(question, widths)
            least = values[offsets[asks] + np.where(counts[asks] > 1, within, 0)]
            starts = starts[least < pack.doc_ids[pack.docs_of(starts)]]
            started[starts] = 1
        change = started.copy()
        change[LENGTH:] -= started[:-LENGTH]
        gone = np.cumsum(change, dtype=np.int32)[:-1] > 0
        for doc_id, start, end in zip(pack.doc_ids, pack.starts, pack.ends, strict=True):
            own = gone[start:end]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
            kept = hashlib.sha256(pack.data[start:end][~own].tobytes()).hexdigest()
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[0::2], edges[1::2], strict=True)]
            rows.append((None if doc_id == _NONE else int(doc_id), int(end - start), int(own.sum()), len(spans), kept, spans))
    frame = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    return frame.astype({"doc_id": "Int64"})


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs (byte offsets), and the digest of what is kept."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    packs = staged_by(packs_of(docs), "packs", "pack", min(1 + total // PART, MOST_PARTS))
    buckets = 1 + total * 2 // ((LENGTH - GRAM + 2) * BUCKET_ANCHORS)
    replies = staged(_by_bucket(_send_anchors(packs, buckets), buckets).applyInPandas(_answer_anchors, REPLIES), "anchor-replies")
    questions = packs.groupBy("pack").cogroup(replies.groupBy("pack")).applyInPandas(_ask(buckets), LETTERS)
    answers = staged(_by_bucket(questions, buckets).applyInPandas(_answer_contexts, REPLIES), "context-replies")
    return packs.groupBy("pack").cogroup(replies.union(answers).groupBy("pack")).applyInPandas(_mark, RESULT)
