"""Language-model scores from a subword lattice.

The pieces of an existing vocabulary give every way to cut a word (with a word-start mark before it)
into pieces. A word's probability is the sum over all cuts of the product of their pieces'
probabilities, by a forward recursion in log space; a text's is the product over its words and one end. Piece
probabilities start from the vocabulary's own scores (for a merge vocabulary a rank: a piece of
rank r weighs 1 / (r + 1)) and are re-estimated from the corpus by forward-backward counts, with the
scores kept as a prior of PRIOR pieces. Bytes no piece covers have one of their own, so every text has a probability.

Work follows the distinct words: they are counted once over all texts, cut once each, and joined back. Words
with a 65536th of all tokens or more, at most 65536 of them, go to the tasks as a small table, so that no key of the
join holds more than that share of rows. Piece counts are as many as the vocabulary has. What each text contributes is one
row per other distinct word.

Defined results: a NULL, empty or blank text is the end alone; a NULL ``doc_id`` belongs to no training fold and is scored; repeated rows are
scored one by one; with no training text the prior alone scores; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import staged

MARK = "▁"
PRIOR = 1000.0
ROUNDS = 2
#: Words of at least this share of tokens (1 / SHARE) are sent to every task: at most SHARE words.
SHARE = 65536
#: Distinct words a task holds before it hands on their counts, and words cut at a time.
HELD = 300_000
AT_ONCE = 40_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Pieces:
    """The vocabulary: byte strings of its pieces, and prior probabilities from its scores; the end is the last one."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        found: dict[bytes, float] = {}
        lowest = 0.0
        for piece in range(model.get_piece_size()):
            score = model.get_score(piece)
            usable = not (model.is_control(piece) or model.is_unknown(piece) or model.is_byte(piece))
            if usable and score > -1e8:
                found[model.id_to_piece(piece).encode()] = 1.0 / (1.0 - score)
                lowest = min(lowest, score)
        for byte in range(256):
            found.setdefault(bytes([byte]), 1.0 / (1.0 - lowest))
        self.pieces = list(found)
        weights = np.array([*found.values(), sum(found.values()) / 100])
        self.prior = weights / weights.sum()
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({len(piece) for piece in self.pieces}):
            ids = np.array([i for i, piece in enumerate(self.pieces) if len(piece) == length])
            data = np.frombuffer(b"".join(self.pieces[i] for i in ids), np.uint8).reshape(-1, length)
            keys = (_BYTES[data] * _powers(_BASE, length)).sum(axis=1, dtype=np.uint64)
            order = np.argsort(keys)
            self.by_length[length] = (keys[order], ids[order])

    @property
    def end(self) -> int:
        return len(self.pieces)

    def weights(self, counts: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithms of the pieces' probabilities; the prior's without counts."""
        if counts is None:
            return np.log(self.prior)
        return np.log((counts + PRIOR * self.prior) / (counts.sum() + PRIOR))

    def _edges(self, data: np.ndarray) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Pieces in words of one length, by end: start, rows that have one, its id."""
        rows, length = data.shape
        powers, inverse = _powers(_BASE, length), _powers(_INVERSE, length)
        sums = np.zeros((length + 1, rows), np.uint64)
        np.cumsum((_BYTES[data] * powers).T, axis=0, dtype=np.uint64, out=sums[1:])
        edges: dict[int, list] = {end: [] for end in range(1, length + 1)}
        for start in range(length):
            for size, (keys, ids) in self.by_length.items():
                if start + size > length:
                    break
                wanted = (sums[start + size] - sums[start]) * inverse[start]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == wanted)
                if len(hit):
                    edges[start + size].append((start, hit, ids[at[hit]]))
        return edges

    def forward(self, data: np.ndarray, logs: np.ndarray, counts: np.ndarray | None = None, weight: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word of one length; expected piece counts, times ``weight``, are added to ``counts``."""
        rows, length = data.shape
        edges = self._edges(data)
        alpha = np.full((length + 1, rows), -np.inf)
        alpha[0] = 0.0
        for end in range(1, length + 1):
            for start, hit, ids in edges[end]:
                alpha[end, hit] = np.logaddexp(alpha[end, hit], alpha[start, hit] + logs[ids])
        total = alpha[length].copy()
        if counts is not None:
            beta = np.full((length + 1, rows), -np.inf)
            beta[length] = 0.0
            for end in range(length, 0, -1):
                for start, hit, ids in edges[end]:
                    through = logs[ids] + beta[end, hit]
                    beta[start, hit] = np.logaddexp(beta[start, hit], through)
                    share = np.exp(alpha[start, hit] + through - total[hit]) * weight[hit]
                    counts += np.bincount(ids, share, minlength=len(counts))
        return total

    def cut(self, words: list[str], logs: np.ndarray, counts: np.ndarray | None = None, weight: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word, words of one length at a time."""
        raw = [(MARK + word).encode("utf-8", "replace") for word in words]
        lengths = np.array([len(word) for word in raw])
        order = np.argsort(lengths, kind="stable")
        totals = np.zeros(len(words))
        at = 0
        while at < len(order):
            length = lengths[order[at]]
            stop = min(np.searchsorted(lengths[order], length, side="right"), at + max(1, (1 << 18) // length))
            chosen = order[at:stop]
            data = np.frombuffer(b"".join(raw[i] for i in chosen), np.uint8).reshape(-1, length)
            totals[chosen] = self.forward(data, logs, counts, None if weight is None else weight[chosen])
            at = stop
        return totals


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _batches_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= AT_ONCE:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


def word_counts(docs: DataFrame, training: Column) -> DataFrame:
    """(word, c): occurrences in training texts of every word of any text; the empty word is the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter({b"": 0})
        others: set = set()

        def rows() -> pd.DataFrame:
            for word in others:
                counts.setdefault(word, 0)
            words = pd.Series([word.decode() for word in counts], dtype=object)
            frame = pd.DataFrame({"word": words, "c": np.fromiter(counts.values(), np.int64, len(counts))})
            counts.clear()
            others.clear()
            return frame

        for batch in batches:
            for text, learn in zip(batch["text"], batch["training"], strict=True):
                found = text_words(text)
                if learn:
                    counts.update(found)
                    counts[b""] += 1
                else:
                    others.update(found)
                if len(counts) + len(others) >= HELD:
                    yield rows()
        yield rows()

    chosen = docs.select("text", F.coalesce(training, F.lit(False)).alias("training"))
    return chosen.mapInPandas(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def learn_pieces(counts: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces after ``rounds`` of expectation and maximisation over the counted words."""
    pieces = Pieces(vocabulary)
    logs = pieces.weights()
    ends = counts.where("word = ''").agg(F.sum("c")).first()[0] or 0
    for _ in range(rounds):
        sent = counts.sparkSession.sparkContext.broadcast(logs)

        def expect(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own = Pieces(vocabulary)
            total = np.zeros(own.end + 1)
            for batch in _batches_of(batches):
                own.cut(list(batch["word"]), sent.value, total, batch["c"].to_numpy(np.float64))
            used = np.flatnonzero(total)
            yield pd.DataFrame({"piece": used, "n": total[used]})

        expected = counts.where("c > 0 AND word <> ''").mapInPandas(expect, "piece int, n double")
        found = np.zeros(pieces.end + 1)
        for piece, n in expected.groupBy("piece").agg(F.sum("n")).collect():
            found[piece] = n
        found[pieces.end] = ends
        logs = pieces.weights(found)
        sent.unpersist()
    return logs


def score_words(counts: DataFrame, vocabulary: str, logs: np.ndarray) -> DataFrame:
    """``counts`` with the log10 probability of each word; of the end for the empty one."""
    sent = counts.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Pieces(vocabulary)
        for batch in _batches_of(batches):
            totals = own.cut(list(batch["word"]), sent.value)
            totals[(batch["word"] == "").to_numpy()] = sent.value[own.end]
            yield pd.DataFrame({"word": batch["word"].astype(object), "c": batch["c"], "lattice": totals / np.log(10)})

    return counts.mapInPandas(run, "word string, c long, lattice double")


PARTS = "row long, doc_id long, key long, n long, n_tokens long, n_known long, base double, lattice double"


def _text_parts(docs: DataFrame, common: list[tuple[str, bool, float, float]]) -> DataFrame:
    """Per text one row for its common words and the end, and one for each other distinct word."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {word.encode(): (seen, base, lattice) for word, seen, base, lattice in sent.value}
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                rows = []
                for doc_id, text in zip(part["doc_id"].astype("object"), part["text"], strict=True):
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    found = Counter(text_words(text))
                    found[b""] = 1
                    n_known, base, lattice = 0, 0.0, 0.0
                    for word, n in found.items():
                        entry = known.get(word)
                        if entry is None:
                            key = xxhash.xxh64_intdigest(word, 42)
                            rows.append((row, doc_id, key - (key >> 63 << 64), n, 0, 0, 0.0, 0.0))
                        else:
                            n_known += n * entry[0]
                            base += n * entry[1]
                            lattice += n * entry[2]
                    rows.append((row, doc_id, row, 0, found.total(), n_known, base, lattice))
                    row += 1
                frame = pd.DataFrame(rows, columns=[field.split()[0] for field in PARTS.split(", ")])
                yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, PARTS)


def score_texts(docs: DataFrame, training: Column, vocabulary: str = "piece_bpe_32k.model", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; learns from the rows where ``training`` holds."""
    counts = staged(word_counts(docs, training), "word-counts")
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    logs = learn_pieces(counts, vocabulary, rounds)
    base = F.log10((F.col("c") + 0.5) / F.lit(size.n + 0.5 * (size.v + 1)))
    scored = score_words(counts, vocabulary, logs).withColumn("base", base)
    table = staged(scored.select(F.xxhash64("word").alias("key"), "word", "c", "base", "lattice"), "word-scores")
    common = table.where((F.col("word") == "") | ((F.col("c") > 0) & (F.col("c") * SHARE >= size.n)))
    sent = [(row.word, row.c > 0, row.base, row.lattice) for row in common.select("word", "c", "base", "lattice").collect()]
    parts = _text_parts(docs, sent)
    words = table.select("key", F.col("c").alias("w_c"), F.col("base").alias("w_base"), F.col("lattice").alias("w_lattice"))
    joined = parts.join(words, "key", "left")
    n = F.col("n")
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when((n > 0) & (F.col("w_c") > 0), n).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + F.when(n > 0, n * F.col("w_base")).otherwise(0.0)).alias("base_score"),
            F.sum(F.col("lattice") + F.when(n > 0, n * F.col("w_lattice")).otherwise(0.0)).alias("score"),
        )
        .select("doc_id", "n_tokens", "n_known", F.lit(size.n).cast("long").alias("train_tokens"), "base_score", "score")
    )
