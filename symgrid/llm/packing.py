"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``, as attention does. Each task packs
its own documents in buffers of about BUFFER_TOKENS tokens, so nothing is shuffled and memory
is bounded: texts longer than a sequence give full pieces first, and the rest are taken by
descending length, each to the lowest-cost sequence with room for it. A piece for which none has room is cut
and fills the cheapest ones that have any. The sequences of a buffer hold exactly its tokens: as many full ones as it fills
and, for the last part, sequences of powers of two, so nothing is padded.

Tokens are those of the given vocabulary; a word after a single blank is tokenized apart from its
neighbours by it, so words met before are looked up.

Defined results: a NULL or empty text is the end token alone; repeated rows are packed like others; an empty table
gives an empty result; a NULL ``doc_id`` stays NULL; other columns are ignored. Which documents share a
sequence follows from how Spark reads the table; the pieces' ids do not depend on it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEQUENCE = 2048
END = 1
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
BUFFER_TOKENS = 1 << 20
#: Words whose tokens are remembered by a task.
REMEMBERED = 300_000

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, cost double"
)

#: Runs of white space beyond this are too long for tiktoken's expressions; the tokenizer of the same vocabulary takes such texts.
LONGEST_BLANK = 100_000

_UNCLEAN = re.compile(r"\s \s?| \s|^ | $")


def byte_bpe(vocabulary: str):
    """The byte-level vocabulary of public tokenizers, as a tiktoken encoding without special tokens."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class WordTokens(dict):
    """Bytes of the ids (unsigned 32-bit, little-endian) of a word after one blank."""

    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def encode(self, text: str) -> bytes:
        if len(text) >= LONGEST_BLANK and max(map(len, re.findall(r"\s+", text)), default=0) >= LONGEST_BLANK:
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.asarray(self.encoding.encode_ordinary(text), "<u4").tobytes()

    @cached_property
    def tokenizer(self):
        import public_tokenizers
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(public_tokenizers.path(self.encoding.name.replace(".tiktoken", ".json")))
        found.encode_special_tokens = True
        return found

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids


def token_bytes(text: str, known: WordTokens) -> bytes:
    """Ids of ``text``. Blanks beside other white space are left to the encoding as they stand."""
    if _UNCLEAN.search(text):
        return known.encode(text)
    first, *rest = text.split(" ")
    return known.encode(first) + b"".join(map(known.__getitem__, rest))


def capacities(total: int) -> list[int]:
    """Lengths of the sequences that hold ``total`` tokens without padding."""
    sizes = [SEQUENCE] * (total // SEQUENCE)
    rest = total % SEQUENCE
    return sizes + [1 << bit for bit in reversed(range(SEQUENCE.bit_length() - 1)) if rest >> bit & 1]


def piece_cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def pack(lengths: list[int]) -> tuple[list[tuple[int, int, int, int, int]], list[int], np.ndarray]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths; sizes and costs of the sequences."""
    sizes = capacities(sum(lengths))
    cost = np.zeros(len(sizes))
    room = np.asarray(sizes, np.int64)
    pieces = []

    def put(doc: int, start: int, tokens: int, sequence: int) -> None:
        pieces.append((doc, start, tokens, sequence, int(sizes[sequence] - room[sequence])))
        room[sequence] -= tokens
        cost[sequence] += piece_cost(tokens)

    rests, full = [], 0
    for doc, length in enumerate(lengths):
        whole = length // SEQUENCE * SEQUENCE
        for start in range(0, whole, SEQUENCE):
            put(doc, start, SEQUENCE, full)
            full += 1
        if length > whole:
            rests.append((length - whole, doc, whole))
    for tokens, doc, start in sorted(rests, key=lambda rest: (-rest[0], rest[1])):
        while tokens:
            fits = room >= tokens
            if fits.any():
                put(doc, start, tokens, int(np.argmin(np.where(fits, cost, np.inf))))
                break
            sequence = int(np.argmin(np.where(room > 0, cost, np.inf)))
            part = int(room[sequence])
            put(doc, start, part, sequence)
            start, tokens = start + part, tokens - part
    return pieces, sizes, cost


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """One row per piece: its ids, place in its document, and place in its sequence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordTokens(byte_bpe(vocabulary))
        end = np.asarray([END], "<u4").tobytes()
        next_id = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        tokens = 0

        def flush() -> pd.DataFrame:
            nonlocal next_id
            pieces, sizes, cost = pack([len(ids) // 4 for _, ids in held])
            rows = [
                (held[doc][0], start, length, held[doc][1][4 * start : 4 * (start + length)], len(held[doc][1]) // 4,
                 next_id + sequence, offset, sizes[sequence], float(cost[sequence]))
                for doc, start, length, sequence, offset in pieces
            ]
            next_id += len(sizes)
            return pd.DataFrame(rows, columns=[field.split()[0] for field in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("object"), batch["text"], strict=True):
                held.append((None if pd.isna(doc_id) else int(doc_id), token_bytes(text or "", known) + end))
                tokens += len(held[-1][1]) // 4
                if tokens >= buffer_tokens:
                    yield flush()
                    held, tokens = [], 0
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
