"""Mining of collocations: phrases of two to four words that stick together, per language.

Every run of words within a piece of text is hashed from prefix sums of a polynomial over its words' hashes, which are themselves
prefix sums of a polynomial over bytes (Rabin and Karp). Counting is by fingerprint and level by level: a phrase can only
be frequent if its parts are. Words are counted, then pairs of frequent words, then runs of three and four whose
pairs are all frequent. The frequent fingerprints of a level reach the tasks as a bitmap of fixed size: one that
is too full lets more through to the shuffle, and drops nothing.

A last pass looks at the text again: occurrences whose fingerprint may be frequent are checked against the text their
fingerprint first points to, word by word and byte by byte, and counted apart where they differ. So only frequent phrases are ever
spelled out, and counts are those of phrases, not of fingerprints. Scores then come from joins of this small table with itself.

Defined results: a NULL text has no words, a NULL ``lang`` is ``und``; repeated rows count each; empty tables and texts give no rows; ties in
the ranking go by count, then by phrase in byte order; other columns are ignored, NULL ids do not matter; texts
longer than a block are a block of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from symgrid.llm.common import staged
from symgrid.llm.shingles import mix

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
#: Groups that a language's phrases are ranked in first.
GROUPS = 64
#: A phrase goes if a longer one around it has this share of its count, in per cent.
ABSORBED = 80
SCALE = 2_000_000
#: Bits of a bitmap of frequent fingerprints: 8 MB.
BITS = 1 << 26
#: Bytes of text hashed at a time, and fingerprints merged before they are sent.
BLOCK = 1 << 20
MERGED = 1 << 20

_U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_BYTES = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True


_kept_powers: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """The first powers of ``base``; kept for the next block, unless a long text needs more than blocks do."""
    known = _kept_powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 2 * BLOCK), base, np.uint64)
        steps[:1] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if count <= 2 * BLOCK:
            _kept_powers[base] = known
    return known[:count]


def _runs(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the runs [start, end) of ``values``, from prefix sums, each shifted back to power 0."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), dtype=np.uint64, out=sums[1:])
    back = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return (sums[ends] - sums[starts]) * back[starts]


class Words:
    """The words of a block of texts of one language."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        breaks = _BREAK[self.data]
        inside = np.concatenate(([False], ~(breaks | _BLANK[self.data])))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.piece = np.cumsum(breaks, dtype=np.int32)[self.starts]
        lengths = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix(_runs(_BYTES[self.data], _BYTE_BASE, self.starts, self.ends) + lengths)
        seed = np.frombuffer(lang.encode("utf-8", "replace"), np.uint8)
        ends = np.array([len(seed)])
        self.lang = mix(_runs(_BYTES[seed], _BYTE_BASE, np.zeros(1, int), ends) + _U(len(seed) + 1))[0]

    def __len__(self) -> int:
        return len(self.starts)

    def places(self, size: int) -> np.ndarray:
        """First words of the runs of ``size`` words that lie in one piece."""
        last = len(self) - size + 1
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def fingerprints(self, size: int, places: np.ndarray) -> np.ndarray:
        if not len(places):
            return np.zeros(0, np.uint64)
        return mix(_runs(self.hashes, _WORD_BASE, places, places + size) * _U(2 * size + 1) + self.lang)

    def frequent(self, size: int, bitmaps: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places and fingerprints of the runs of ``size`` words whose parts may all be frequent, as far as bitmaps tell."""
        places = self.places(size)
        known = max((level for level in bitmaps if level < size), default=0)
        if known:
            may = np.zeros(len(self), bool)
            parts = self.places(known)
            may[parts] = has(bitmaps[known], self.fingerprints(known, parts))
            keep = np.ones(len(places), bool)
            for shift in range(size - known + 1):
                keep &= may[places + shift]
            places = places[keep]
        return places, self.fingerprints(size, places)

    def numbered(self) -> np.ndarray:
        """A number for each word, the same for the same bytes only: hashes that stand for different words are told apart."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        model = first[number]
        same = (self.ends - self.starts) == (self.ends - self.starts)[model]
        sizes = np.where(same, self.ends - self.starts, 0)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        unequal = self.data[np.repeat(self.starts, sizes) + within] != self.data[np.repeat(self.starts[model], sizes) + within]
        if same.all() and not unequal.any():
            return number
        known: dict[bytes, int] = {}
        text = self.data.tobytes()
        return np.array([known.setdefault(text[a:b], len(known)) for a, b in zip(self.starts, self.ends, strict=True)], np.int64)

    def counted(self, size: int, places: np.ndarray, prints: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place, count) of each phrase among these places: equal fingerprints, checked word by word."""
        _, first, group, counts = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        if all(np.array_equal(numbers[places + k], numbers[places[first[group]] + k]) for k in range(size)):
            return places[first], counts
        rows = np.stack([numbers[places + k] for k in range(size)], axis=1)
        _, first, counts = np.unique(rows, axis=0, return_index=True, return_counts=True)
        return places[first], counts


def has(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & _U(len(bitmap) * 8 - 1)
    return (bitmap[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Words]]:
    """Language and words of blocks of texts; a language's texts are hashed once they fill a block."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            if not pd.isna(text) and text:
                lang = "und" if pd.isna(lang) else lang
                held.setdefault(lang, []).append(text.encode("utf-8", "replace").lower())
                sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                if sizes[lang] >= BLOCK:
                    sizes.pop(lang)
                    yield lang, Words(lang, held.pop(lang))
    for lang, texts in held.items():
        yield lang, Words(lang, texts)


def _merged(prints: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    together, times = np.concatenate(prints), np.concatenate(counts)
    unique, group = np.unique(together, return_inverse=True)
    return unique, np.bincount(group, times, len(unique)).astype(np.int64)


def _fingerprint_counts(docs: DataFrame, sizes: tuple[int, ...], bitmaps: dict[int, object]) -> DataFrame:
    """(size, print, times) of runs of these sizes, pre-aggregated in each task and summed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = {level: bitmap.value for level, bitmap in bitmaps.items()}
        held = {size: ([], []) for size in sizes}
        waiting = dict.fromkeys(sizes, 0)

        def sent(size: int) -> pd.DataFrame:
            prints, times = held[size]
            return pd.DataFrame({"size": np.int32(size), "print": prints[0].view(np.int64), "times": times[0]})

        for _, words in _blocks(batches):
            for size in sizes:
                prints, times = np.unique(words.frequent(size, frequent)[1], return_counts=True)
                held[size][0].append(prints)
                held[size][1].append(times)
                waiting[size] += len(prints)
                if waiting[size] > MERGED:
                    unique, total = _merged(*held[size])
                    held[size] = ([unique], [total])
                    if len(unique) > MERGED // 2:
                        yield sent(size)
                        held[size] = ([], [])
                    waiting[size] = sum(map(len, held[size][0]))
        for size in sizes:
            if held[size][0]:
                held[size] = tuple([part] for part in _merged(*held[size]))
                yield sent(size)

    counted = docs.select("lang", "text").mapInPandas(run, "size int, print long, times long")
    return counted.groupBy("size", "print").agg(F.sum("times").alias("times"))


def _bitmap(prints: DataFrame, bits: int) -> np.ndarray:
    """The bits of these fingerprints; each row that reaches the driver is 4 KB of the bitmap."""
    place = F.col("print").bitwiseAND(F.lit(bits - 1)) + 1
    rows = prints.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():
        low = (row.bucket - 1) * 4096
        part = np.frombuffer(bytes(row.bits), np.uint8)
        bitmap[low : low + 4096] = part[: len(bitmap) - low]
    return bitmap


def _spelled(docs: DataFrame, bitmaps: dict[int, object], longest: int) -> DataFrame:
    """(lang, size, phrase, times) of phrases that may be frequent, per block; the words of a language with size 0."""

    def spelled(lang: str, size: int, phrases: list[str], times: np.ndarray) -> pd.DataFrame:
        # Plain objects: pandas' own strings come in chunks, which a struct of Arrow does not take.
        names = pd.Series([lang] * len(phrases), dtype=object)
        return pd.DataFrame({"lang": names, "size": np.int32(size), "phrase": pd.Series(phrases, dtype=object), "times": times})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = {level: bitmap.value for level, bitmap in bitmaps.items()}
        for lang, words in _blocks(batches):
            yield spelled(lang, 0, [""], np.array([len(words)]))
            if not len(words):
                continue
            numbers, text = words.numbered(), words.data.tobytes()
            for size in range(1, longest + 1):
                places, prints = words.frequent(size, frequent)
                may = has(frequent[size], prints)
                first, counts = words.counted(size, places[may], prints[may], numbers)
                spans = [(words.starts[first + k].tolist(), words.ends[first + k].tolist()) for k in range(size)]
                parts = [[text[a:b] for a, b in zip(*span, strict=True)] for span in spans]
                phrases = [b" ".join(phrase).decode("utf-8", "replace") for phrase in zip(*parts, strict=True)]
                yield spelled(lang, size, phrases, counts)

    return docs.select("lang", "text").mapInPandas(run, "lang string, size int, phrase string, times long")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """(lang, size, phrase, times) of all phrases of up to ``longest`` words with ``min_count`` occurrences; size 0: words of the language."""
    spark = docs.sparkSession
    bitmaps: dict[int, object] = {}
    for sizes in [(1,), (2,), tuple(range(3, longest + 1))]:
        if not sizes:
            continue
        counts = _fingerprint_counts(docs, sizes, bitmaps).where(F.col("times") >= min_count)
        counts = staged(counts, "phrases-prints")
        bitmaps |= {size: spark.sparkContext.broadcast(_bitmap(counts.where(F.col("size") == size), bits)) for size in sizes}
    spelled = _spelled(docs, bitmaps, longest).groupBy("lang", "size", "phrase").agg(F.sum("times").alias("times"))
    return staged(spelled.where((F.col("size") == 0) | (F.col("times") >= min_count)), "phrases-spelled")


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, bits: int = BITS) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut of lowest score, ``n`` the words of the language.
    """
    counts = frequent_phrases(docs, min_count, longest, bits)
    phrases = counts.where("size > 0").select("lang", "phrase", "times")
    candidates = counts.where("size > 1").select("lang", "phrase", "size", F.col("times").alias("a"), F.split("phrase", " ").alias("words"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        _part(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        _part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("times").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("times").alias("r"))
    # Exact: a product of 38 digits, divided rounding down.
    score = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV CAST(l + r AS DECIMAL(19,0)) AS BIGINT)")
    cut = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("size") - size + 1), lambda at: _part(F.col("words"), at, size)),
        )
    )
    around = (
        candidates.where("size > 2")
        .select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("around") < ABSORBED * F.col("a"), F.lit(True))
    )
    words = counts.where("size = 0").select("lang", F.col("times").alias("n"))
    # First within groups of phrases, so that what the last step sorts of a language is bounded.
    best = kept.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(GROUPS)))
    for by in (["lang", "group"], ["lang"]):
        in_order = Window.partitionBy(*by).orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words WHERE len(ws) > 0),
grams AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k AS size, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
frequent AS (SELECT * FROM f WHERE a >= {MIN_COUNT}),
candidates AS (SELECT *, string_split(phrase, ' ') AS ws FROM frequent WHERE size > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1 : k], ' ') AS lp, array_to_string(ws[k + 1 : size], ' ') AS rp
  FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, ({SCALE}::HUGEINT * c.a) // (l.a + r.a) AS score
  FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.phrase = c.lp JOIN frequent r ON r.lang = c.lang AND r.phrase = c.rp),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, max(a) AS around
  FROM candidates, (SELECT unnest([2, 3]) AS k), (SELECT unnest([1, 2, 3]) AS i) WHERE k < size AND i + k - 1 <= size GROUP BY 1, 2),
kept AS (
  SELECT w.* FROM lowest w LEFT JOIN inner_phrases i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE around IS NULL OR 100 * around < {ABSORBED} * a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score::BIGINT AS score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
