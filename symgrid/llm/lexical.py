"""Ranked lexical search of many queries at once, with the sums that queries share computed once.

A document's score for a query is a sum over the query's terms, so queries that have terms in common have partial sums in
common. :func:`share` mines these: the pair of summands that most queries hold becomes a node of its own, again and again, until none is
held twice. Nodes are built on nodes, so larger shared sets come out as chains of pairs. The result is a graph from single terms up
to queries. A block of documents is an accumulator row per node: leaves from term counts, shared nodes once each, level by level, and last the
queries, each the sum of the few nodes that are left of it.

Two passes: documents become counts of the queries' terms, written once; these give the corpus statistics and then the scores. Each
task keeps the best of each query, so what is shuffled is ``top`` rows per query and task, merged in two steps.
Queries are taken in blocks of at most BLOCK_TERMS terms (one longer query is a block of its own); a block is all that the driver or a task holds
of them, and is finished and written before the next is read.

Defined results: NULL and empty texts have no terms, so such documents are never found and such queries find nothing; documents are
rows, so repeated rows are ranked each; equal scores go by ascending ``doc_id``, NULL last; each row of the queries
is one query, repeated ids too; empty tables give an empty result; other columns are ignored; whole texts count, however long.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from symgrid.llm.common import staged

TOP = 20
#: Terms of the queries of a block, repeats included.
BLOCK_TERMS = 1 << 16
#: Accumulators held at a time, of 8 bytes.
ACCUMULATORS = 1 << 21
#: Groups that a query's rows are first merged in.
SALTS = 64

#: Term bytes stay, ASCII that is neither letter nor digit separates. ``bytes.lower`` folds A-Z only.
_SEPARATED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_POSTINGS_DDL = "doc_id long, n long, terms binary, counts binary"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().translate(_SEPARATED).split()


class SharedSums:
    """Queries as sums of nodes. Leaves are (term, times); ``levels`` has arrays (node, left, right), each built of nodes before it."""

    def __init__(self, leaves: list[tuple[int, int]], levels: list[np.ndarray], queries: list[list[int]], nodes: int):
        self.leaf_terms = np.array([term for term, _ in leaves], np.int64)
        self.leaf_times = np.array([times for _, times in leaves], np.int64)
        self.levels = levels
        self.nodes = nodes
        self.filled = np.array([at for at, parts in enumerate(queries) if parts], np.int64)
        self.parts = np.array([node for parts in queries for node in parts], np.int64)
        sizes = [len(parts) for parts in queries if parts]
        self.bounds = np.cumsum([0, *sizes])[:-1]
        self.queries = len(queries)

    def scores(self, contributions: np.ndarray) -> np.ndarray:
        """(query, document) from (term, document)."""
        sums = np.empty((self.nodes, contributions.shape[1]), np.int64)
        np.multiply(contributions[self.leaf_terms], self.leaf_times[:, None], out=sums[: len(self.leaf_terms)])
        for level in self.levels:
            sums[level[:, 0]] = sums[level[:, 1]] + sums[level[:, 2]]
        scores = np.zeros((self.queries, contributions.shape[1]), np.int64)
        if len(self.filled):
            # One gather per query: a block's worth of all queries at once would not fit.
            for query, parts in zip(self.filled, np.split(self.parts, self.bounds[1:]), strict=True):
                scores[query] = sums[parts].sum(axis=0)
        return scores


def share(queries: list[dict[int, int]]) -> SharedSums:
    """The graph of sums of queries given as term: times."""
    leaves = sorted({leaf for query in queries for leaf in query.items()})
    number = {leaf: at for at, leaf in enumerate(leaves)}
    held = [{number[leaf] for leaf in query.items()} for query in queries]
    holders: dict[int, set[int]] = {}
    for at, parts in enumerate(held):
        for node in parts:
            holders.setdefault(node, set()).add(at)
    # A node of one query is shared by none; pairs are counted among the others alone.
    pairs = Counter(pair for parts in held for pair in combinations(sorted(n for n in parts if len(holders[n]) > 1), 2))
    heap = [(-count, pair) for pair, count in pairs.items() if count > 1]
    heapq.heapify(heap)
    depth = [0] * len(leaves)
    built: list[tuple[int, int, int]] = []
    while heap:
        count, (left, right) = heapq.heappop(heap)
        both = holders[left] & holders[right]
        if len(both) < 2:
            continue
        if len(both) < -count:
            heapq.heappush(heap, (-len(both), (left, right)))
            continue
        node = len(depth)
        depth.append(1 + max(depth[left], depth[right]))
        built.append((node, left, right))
        beside: Counter = Counter()
        for at in both:
            held[at] -= {left, right}
            beside.update(held[at])
            held[at].add(node)
            holders[left].discard(at)
            holders[right].discard(at)
        holders[node] = both
        for other, times in beside.items():
            if times > 1:
                heapq.heappush(heap, (-times, (other, node)))
    levels = [
        np.array([row for row in built if depth[row[0]] == level], np.int64) for level in range(1, max(depth, default=0) + 1)
    ]
    return SharedSums(leaves, levels, [sorted(parts) for parts in held], len(depth))


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with any term at all its number of terms, and counts of those of the vocabulary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].astype("object"), batch["text"], strict=True):
                words = terms_of(None if pd.isna(text) else text)
                if not words:
                    continue
                found = [at for at in map(vocabulary.get, words) if at is not None]
                terms, counts = np.unique(np.array(found, np.int32), return_counts=True)
                rows.append((None if pd.isna(doc_id) else int(doc_id), len(words), terms.tobytes(), counts.astype(np.int32).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "terms", "counts"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, _POSTINGS_DDL)


def _document_frequencies(postings: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: a count per task and term, summed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch["terms"]), np.int32)
            total += np.bincount(held, minlength=size)
        terms = np.flatnonzero(total)
        yield pd.DataFrame({"term": terms, "df": total[terms]})

    counted = postings.select("terms").mapInPandas(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    frequencies = np.zeros(size, np.int64)
    frequencies[counted["term"].to_numpy(np.int64)] = counted["df"].to_numpy(np.int64)
    return frequencies


def term_weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Best:
    """The best documents of each query so far: parallel arrays sorted by (query, score descending, id)."""

    def __init__(self, top: int):
        self.top = top
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, no_id: np.ndarray) -> None:
        least = np.ones(len(scores), np.int64)
        full = np.flatnonzero(np.bincount(self.query, minlength=len(scores)) >= self.top)
        last = np.searchsorted(self.query, full, "right") - 1
        least[full] = self.score[last]
        query, at = np.nonzero(scores >= least[:, None])
        merged = [
            np.concatenate(pair)
            for pair in ((self.query, query), (self.score, scores[query, at]), (self.doc, docs[at]), (self.no_id, no_id[at]))
        ]
        order = np.lexsort((merged[2], merged[3], -merged[1], merged[0]))
        query = merged[0][order]
        first = np.searchsorted(query, query, "left")
        kept = order[np.arange(len(order)) - first < self.top]
        self.query, self.score, self.doc, self.no_id = (values[kept] for values in merged)


def _best_of_tasks(postings: DataFrame, sums: SharedSums, weights: np.ndarray, documents: int, terms: int, top: int) -> DataFrame:
    """(query, doc_id, score): the ``top`` best of each task."""
    step = max(1, ACCUMULATORS // max(1, sums.nodes + len(weights)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(top)
        for batch in batches:
            no_id = batch["doc_id"].isna().to_numpy()
            ids = batch["doc_id"].fillna(0).astype("int64").to_numpy()
            lengths = batch["n"].to_numpy(np.int64)
            damping = 12 * (75 + 25 * lengths * documents // terms)
            for low in range(0, len(batch), step):
                block = slice(low, low + step)
                sizes = [len(held) // 4 for held in batch["terms"].iloc[block]]
                doc = np.repeat(np.arange(len(sizes)), sizes)
                term = np.frombuffer(b"".join(batch["terms"].iloc[block]), np.int32)
                count = np.frombuffer(b"".join(batch["counts"].iloc[block]), np.int32).astype(np.int64)
                contributions = np.zeros((len(weights), len(sizes)), np.int64)
                contributions[term, doc] = weights[term] * (1_000_000_000 * count // (1000 * count + damping[block][doc]))
                best.add(sums.scores(contributions), ids[block], no_id[block])
        found = pd.DataFrame({"query": best.query, "doc_id": pd.array(best.doc, "Int64"), "score": best.score})
        found.loc[best.no_id, "doc_id"] = pd.NA
        yield found

    return postings.mapInPandas(run, "query long, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best of each query with their rank; first of each of SALTS groups, then of all."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top).drop("salt")


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    block, size = [], 0
    for row in items.select("item_id", "text").orderBy("item_id", F.xxhash64("text"), "text").toLocalIterator():
        words = terms_of(row.text)
        if block and size + len(words) > block_terms:
            yield block
            block, size = [], 0
        block.append((row.item_id, words))
        size += len(words)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    results = []
    for block in _blocks(items, block_terms):
        vocabulary = {word: at for at, word in enumerate(sorted({word for _, words in block for word in words}))}
        postings = staged(_postings(docs, vocabulary), "lexical-postings")
        documents, terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequencies = _document_frequencies(postings, len(vocabulary))
        weights = np.array([term_weight(documents, int(frequency)) for frequency in frequencies], np.int64)
        sums = share([Counter(vocabulary[word] for word in words) for _, words in block])
        found = _ranked(_best_of_tasks(postings, sums, weights, documents, terms, top), top)
        ids = spark.createDataFrame([(at, item_id) for at, (item_id, _) in enumerate(block)], f"query long, item_id {kind.simpleString()}")
        named = found.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")
        results.append(staged(named, "lexical-found"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.union, results)


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
sizes AS (SELECT r, doc_id, len(words) AS n FROM docs WHERE len(words) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
postings AS (SELECT r, word, count(*) AS tf FROM (SELECT r, unnest(words) AS word FROM docs) GROUP BY r, word),
weights AS (
  SELECT word, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY word, docs),
items AS (
  SELECT q, item_id, word, count(*) AS times
  FROM (SELECT q, item_id, unnest(words) AS word FROM (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS words FROM benchmark))
  GROUP BY q, item_id, word),
damped AS (SELECT r, doc_id, 12 * (75 + (25 * n * docs) // terms) AS damping FROM sizes, totals),
scores AS (
  SELECT q, item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + damping)))::BIGINT AS score
  FROM items JOIN weights USING (word) JOIN postings USING (word) JOIN damped USING (r) GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
