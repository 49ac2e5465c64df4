"""Best-fit packing of whole documents into as few training sequences as possible, in bulk-synchronous supersteps.

Documents are cut only beyond ``sequence`` tokens. Spark sorts the pieces into ranges of length and numbers them within
each length, so that pieces of one length are a run of ranks; open sequences with one gap are a run as well. A superstep sweeps both
in ascending order: the pieces met wait, longest on top, and each gap takes the longest that fits, as often as that fits, which gives
every piece its successor among the gaps. Pieces of one length that want one gap, and gaps that want one piece, are told apart by rank.
Then the gaps shrink, and the next superstep starts. A gap halves each time it takes something, so the supersteps
after a set of sequences is opened are at most log2(sequence). Pieces over half a sequence open one each; if nothing fits any
more, as many are opened as the rest needs at least.

What a sweep reads is one row per length, at most ``sequence`` of them however many documents there are, and what it leaves is a
table of runs: no piece passes the driver, and none is moved between supersteps. The pieces themselves are sorted once,
without their tokens, and find their place by length and rank.

Defined results: a NULL or empty text is the end token alone; repeated rows are packed like others; an empty table gives an
empty result; a NULL ``doc_id`` stays NULL; other columns are ignored; texts of any length are cut, never dropped.
Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import staged

SEQUENCE = 2048
END = 0
VOCABULARY = "word_bpe_49k.json"
#: Words whose tokens are remembered by a task.
REMEMBERED = 200_000

#: Characters whose classes and lower case are the same in every version of Unicode; other words are left to the tokenizer.
_PLAIN = re.compile(r"[!-~¡-¬®-ſ]*")
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_PIECE_DDL = "row long, doc_id long, piece int, start long, length int, ids binary"
_RANK_DDL = "row long, length int, range int, nth long"


class WordTokens(dict):
    """Bytes of the ids (unsigned 32-bit, little-endian) of a word in UTF-8, under a vocabulary with marked word ends.

    The vocabulary's merges are ranked by id, as the byte-pair merger of tiktoken wants them; a byte that no text holds marks the
    end of a word. Words of other than common characters are encoded by the tokenizer.
    """

    WORD_END = b"\xff"

    def __init__(self, vocabulary: str):
        super().__init__()
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        path = public_tokenizers.path(vocabulary)
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        with open(path) as file:
            ids = json.load(file)["model"]["vocab"]
        ranks = {self._token_bytes(token): rank for token, rank in ids.items()}
        merger = tiktoken.Encoding(vocabulary, pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self._merge = merger._core_bpe.encode_single_piece
        self._pieces = regex.compile(_PIECES).findall

    @classmethod
    def _token_bytes(cls, token: str) -> bytes:
        body = token.removesuffix("</w>")
        text = bytes(map(_byte_letters().__getitem__, body))
        return text if body == token else text + cls.WORD_END

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha():
            ids = self._merge(word.lower() + self.WORD_END)
        elif _PLAIN.fullmatch(text):
            lower = unicodedata.normalize("NFC", text).lower()
            ids = [token for piece in self._pieces(lower) for token in self._merge(piece.encode() + self.WORD_END)]
        else:
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        packed = array("I", ids).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) < 64:
            self[word] = packed
        return packed

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


@cache
def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + place): byte for place, byte in enumerate(others)}


def token_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece of at most ``sequence`` tokens: ``row`` numbers it, ``ids`` are its tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordTokens(vocabulary)
        end = array("I", [END]).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].astype("object"), batch["text"], strict=True):
                ids = known.of("" if pd.isna(text) else text) + end
                for piece, start in enumerate(range(0, len(ids) // 4, sequence)):
                    part = ids[4 * start : 4 * (start + sequence)]
                    rows.append((row, None if pd.isna(doc_id) else int(doc_id), piece, start, len(part) // 4, part))
                    row += 1
            yield pd.DataFrame(rows, columns=[field.split()[0] for field in _PIECE_DDL.split(", ")]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, _PIECE_DDL)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces sorted into ranges of (length, row), ``nth`` counting those of a length within a range."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: dict[int, int] = {}
        for batch in batches:
            batch["range"] = TaskContext.get().partitionId()
            batch["nth"] = batch.groupby("length").cumcount() + batch["length"].map(met).fillna(0).astype("int64")
            last = batch.groupby("length")["nth"].max()
            met = {int(length): int(nth) + 1 for length, nth in last.items()}
            yield batch

    ranged = pieces.select("row", "length").repartitionByRange("length", "row").sortWithinPartitions("length", "row")
    return ranged.mapInPandas(run, _RANK_DDL)


class Supersteps:
    """Runs of pieces and of gaps, and the placements they make.

    ``placements`` rows: length, first and last rank (exclusive) of the pieces, first sequence, pieces per sequence, offset
    of the first of these in its sequence.
    """

    def __init__(self, counts: dict[int, int], sequence: int = SEQUENCE):
        self.sequence = sequence
        self.left = {length: count for length, count in counts.items() if count}
        self.used = dict.fromkeys(self.left, 0)
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.opened = 0
        self.steps = 0
        self.placements: list[tuple[int, int, int, int, int, int]] = []

    def _open(self, room: int, count: int) -> int:
        first = self.opened
        self.opened += count
        if room:
            self.gaps.setdefault(room, []).append((first, count))
        return first

    def _place(self, length: int, first_sequence: int, sequences: int, each: int, offset: int) -> None:
        rank = self.used[length]
        pieces = sequences * each
        self.placements.append((length, rank, rank + pieces, first_sequence, each, offset))
        self.used[length] = rank + pieces
        self.left[length] -= pieces
        if not self.left[length]:
            del self.left[length]

    def run(self) -> list[tuple[int, int, int, int, int, int]]:
        for length in sorted(self.left, reverse=True):
            if 2 * length > self.sequence:
                count = self.left[length]
                self._place(length, self._open(self.sequence - length, count), count, 1, 0)
        while self.left:
            if not self._sweep():
                tokens = sum(length * count for length, count in self.left.items())
                self._open(self.sequence, -(-tokens // self.sequence))
        return self.placements

    def _sweep(self) -> bool:
        """One superstep; False if no piece fits any gap."""
        self.steps += 1
        waiting: list[int] = []
        lengths = sorted(self.left, reverse=True)
        after: dict[int, list[tuple[int, int]]] = {}
        placed = len(self.placements)
        for room in sorted(self.gaps):
            while lengths and lengths[-1] <= room:
                waiting.append(lengths.pop())
            for first, count in self.gaps[room]:
                while count and waiting:
                    length = waiting[-1]
                    each = min(room // length, self.left[length])
                    sequences = min(count, self.left[length] // each)
                    self._place(length, first, sequences, each, self.sequence - room)
                    if length not in self.left:
                        waiting.pop()
                    if room - each * length:
                        after.setdefault(room - each * length, []).append((first, sequences))
                    first, count = first + sequences, count - sequences
                if count:
                    after.setdefault(room, []).append((first, count))
        self.gaps = after
        return len(self.placements) > placed


def best_fit(docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    ``ids`` leave the tables they were written to only where they are asked for.
    """
    pieces = staged(token_pieces(docs, vocabulary, sequence), "bestfit-pieces")
    ranked = staged(_ranked(pieces), "bestfit-ranks")
    # A range holds neighbouring lengths, so this has at most a row per length and one per range.
    runs = ranked.groupBy("length", "range").count().toPandas().sort_values(["length", "range"], ignore_index=True)
    placements = Supersteps({int(k): int(v) for k, v in runs.groupby("length")["count"].sum().items()}, sequence).run()

    # Ranks of all lengths on one line: pieces before a run in the order of (length, range, nth).
    runs["before"] = runs["count"].cumsum() - runs["count"]
    first_of_length = runs.groupby("length")["before"].min().to_dict()
    places = np.array(
        [(first_of_length[length] + low, first, each, offset) for length, low, _, first, each, offset in placements], np.int64
    ).reshape(-1, 4)
    places = places[np.argsort(places[:, 0])]
    run_keys = (runs["length"].to_numpy(np.int64) << 32) | runs["range"].to_numpy(np.int64)
    run_starts = runs["before"].to_numpy(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            at = run_starts[np.searchsorted(run_keys, (length << 32) | batch["range"].to_numpy(np.int64))] + batch["nth"].to_numpy()
            low, first, each, offset = places[np.searchsorted(places[:, 0], at, "right") - 1].T
            yield pd.DataFrame(
                {"row": batch["row"], "sequence_id": first + (at - low) // each, "offset": offset + (at - low) % each * length}
            )

    placed = ranked.mapInPandas(run, "row long, sequence_id long, offset long")
    return (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .join(placed, "row")
        .select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32", "sequence_id", "offset")
    )
