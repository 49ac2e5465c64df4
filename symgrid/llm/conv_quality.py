"""Quality classifier: a convolutional network over bytes, in numpy.

Each of FILTERS learned filters is WIDTH bytes wide and has a weight for each byte value at each
place. A text's UTF-8 bytes are cut into chunks of CHUNK bytes, each overlapping the next by half, until the
whole text is covered. A filter's response in a chunk is its greatest one there (rectified);
the greatest and the mean response over the chunks give 2 * FILTERS features, which a logistic layer combines into one
probability.

The network is trained on the driver on at most SAMPLE labelled texts (lowest hash of the id first; the bound is
a parameter), each with all its chunks, by the very responses that scoring computes. Scoring reads every byte of every text.

Defined results: NULL and empty texts have no chunk and get the probability of no responses;
repeated rows are scored one by one; with no labelled text, or one class alone, every score is that class's smoothed
share; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import sampled_ids

FILTERS = 16
WIDTH = 5
CHUNK = 512
HALF = CHUNK // 2
SAMPLE = 6000
EPOCHS = 8
#: A small sample is gone over more often, for as many steps at least, of as many texts each.
LEAST_STEPS, TEXTS_A_STEP = 300, 32
#: Bytes whose responses are held at a time, a whole number of half chunks.
SLICE = 1 << 15


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,)
    offset: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Response of each filter at each place of ``data``, which is padded by WIDTH - 1 zero bytes."""
        places = len(data) - WIDTH + 1
        total = np.take(self.filters[0], data[:places], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.filters[k], data[k : k + places], axis=0)
        return total

    def half_peaks(self, raw: np.ndarray) -> np.ndarray:
        """Greatest response of each filter in each half chunk, SLICE bytes at a time."""
        data = np.concatenate((raw, np.zeros(WIDTH - 1, np.uint8)))
        halves = []
        for at in range(0, len(raw), SLICE):
            part = self.responses(data[at : min(at + SLICE, len(raw)) + WIDTH - 1])
            halves.append(np.maximum.reduceat(part, np.arange(0, len(part), HALF), axis=0))
        return np.concatenate(halves)

    def features(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        if not len(raw):
            return np.zeros(2 * FILTERS, np.float32)
        peaks = self.half_peaks(raw)
        chunks = np.maximum(peaks[:-1], peaks[1:]) if len(peaks) > 1 else peaks
        chunks = np.maximum(chunks + self.bias, 0)
        return np.concatenate((chunks.max(axis=0), chunks.mean(axis=0)))

    def chunk_peaks(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each filter in each chunk the greatest response, before the bias, and its place in ``raw``."""
        data = np.concatenate((raw, np.zeros(WIDTH - 1, np.uint8)))
        peaks, places = [], []
        for at in range(0, len(raw), SLICE):
            part = self.responses(data[at : min(at + SLICE, len(raw)) + WIDTH - 1])
            halves = -(-len(part) // HALF)
            padded = np.full((halves * HALF, FILTERS), -np.inf, np.float32)
            padded[: len(part)] = part
            padded = padded.reshape(halves, HALF, FILTERS)
            best = padded.argmax(axis=1)
            peaks.append(np.take_along_axis(padded, best[:, None], axis=1)[:, 0])
            places.append(best + at + HALF * np.arange(halves)[:, None])
        peak, place = np.concatenate(peaks), np.concatenate(places)
        if len(peak) > 1:
            later = peak[1:] > peak[:-1]
            peak, place = np.where(later, peak[1:], peak[:-1]), np.where(later, place[1:], place[:-1])
        return peak, place

    def score(self, text: str | None) -> float:
        logit = float(self.features(text) @ self.weights + self.offset)
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def constant_network(share: float) -> Network:
    return Network(
        np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32),
        np.zeros(2 * FILTERS, np.float32), float(np.log(share / (1 - share))),
    )


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[bytes, int]]:
    """UTF-8 bytes and label of at most ``sample`` labelled documents, one of each id; NULL labels and empty texts teach nothing.

    The sample is drawn from the labels, and its bounded list goes to where texts are read.
    """
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", "quality")
    chosen = known.join(F.broadcast(sampled_ids(known, sample)), "doc_id").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    texts = docs.select("doc_id", "text").where(F.length("text") > 0).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").cast("binary").alias("raw"), F.min("quality").alias("quality"))
    return [(bytes(row.raw), row.quality) for row in sorted(one.collect(), key=lambda row: row.doc_id)]


def train(sample: list[tuple[bytes, int]], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the logistic loss; gradients pass to the places of the greatest responses alone."""
    labels = np.array([label for _, label in sample], np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if labels.min(initial=1) == labels.max(initial=0) or len(labels) < 2:
        return constant_network(float(share))
    rng = np.random.default_rng(seed)
    docs = [np.frombuffer(raw, np.uint8) for raw, _ in sample]
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    net = Network(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0,
    )
    names = ("filters", "bias", "weights", "offset")
    first = {name: np.zeros_like(getattr(net, name), dtype=np.float64) for name in names}
    second = {name: np.zeros_like(getattr(net, name), dtype=np.float64) for name in names}
    step, batch = 0, TEXTS_A_STEP
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(docs)))):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            found = [net.chunk_peaks(docs[i]) for i in chosen]
            sizes = np.array([len(peaks) for peaks, _ in found])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            owner = np.repeat(np.arange(len(chosen)), sizes)
            peak = np.concatenate([peaks for peaks, _ in found]) + net.bias
            # The batch's texts stand one after the other, each followed by zero bytes.
            data = np.concatenate([np.concatenate((docs[i], np.zeros(WIDTH - 1, np.uint8))) for i in chosen])
            ahead = np.concatenate(([0], np.cumsum([len(docs[i]) + WIDTH - 1 for i in chosen])[:-1]))
            place = np.concatenate([places + first_byte for (_, places), first_byte in zip(found, ahead, strict=True)])
            relu = np.maximum(peak, 0)
            most = np.maximum.reduceat(relu, starts, axis=0)
            mean = np.add.reduceat(relu, starts, axis=0) / sizes[:, None]
            logit = np.concatenate((most, mean), axis=1) @ net.weights + net.offset
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[chosen]) * weight[chosen] / len(chosen)
            back = error[:, None] * net.weights
            # Chunks that overlap may share their greatest response, and then share its gradient.
            isbest = ((relu == most[owner]) & (relu > 0)).astype(np.float64)
            isbest /= np.maximum(1, np.add.reduceat(isbest, starts, axis=0))[owner]
            grad_peak = (back[owner, :FILTERS] * isbest + back[owner, FILTERS:] / sizes[owner, None]) * (peak > 0)
            grads = {name: np.zeros_like(first[name]) for name in names}
            column = np.broadcast_to(np.arange(FILTERS), place.shape)
            for k in range(WIDTH):
                np.add.at(grads["filters"][k], (data[place + k], column), grad_peak)
            grads["bias"] = grad_peak.sum(axis=0)
            grads["weights"] = error @ np.concatenate((most, mean), axis=1) + 1e-4 * net.weights
            grads["offset"] = np.asarray(error.sum())
            step += 1
            for name in names:
                first[name] = 0.9 * first[name] + 0.1 * grads[name]
                second[name] = 0.999 * second[name] + 0.001 * grads[name] ** 2
                move = 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, (getattr(net, name) - move).astype(np.float32) if name != "offset" else float(net.offset - move))
    return net


def quality_score(text: Column, network: Network) -> Column:
    """Probability that a text is of good quality."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([network.score(text) for text in texts], dtype="float64")

    return score.asNondeterministic()(text)
