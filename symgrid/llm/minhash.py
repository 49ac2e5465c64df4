"""Near duplicates by b-bit MinHash.

Each text's set of word shingles gives PERMUTATIONS minima. Bands of ROWS minima name candidate groups; BITS
bits of a hash of every minimum, packed into a few integers, estimate a candidate pair's similarity by
counting equal groups of bits, corrected for chance. Candidates near or above the threshold are
confirmed on the full shingle sets of whole texts, so a link is exact. At a similarity of 0.8 a
pair shares no band with probability 3e-6, and is estimated too low with one of 1e-5 (the binomial tail; 3 of 100,000
simulated pairs of 5 and 4 shingles).

Work that would grow with the square of a group is avoided without losing links:

* texts with equal sets form one class, and one representative stands for it;
* first each representative is confirmed against the smallest of its groups, and of the closer groups that two
  bands name together; confirmed links give components;
* then, in every group that still holds several components, the members outside its largest one
  are compared with those of the others by their estimates, and confirmed if these are near the threshold. Pairs inside a
  component need no look: they can add no link between different components;
* where that would take more than CROWD * CROWD comparisons in a group (pages on one template, say), its members are
  compared only if they share one of their rarest shingles: of two sets with enough in common, the first few in any one
  order of all shingles have one in common (see ``sharing_rare_shingles``). No link is lost by it, and what
  a template's pages all have is not among them.

Components are computed on tables; groups, links and components never reach the driver.

Defined results: a NULL, empty or blank text has an empty set and is linked with nothing; texts
of fewer words than a shingle have their whole sequence as one; rows that share a ``doc_id`` count as one document;
a NULL ``doc_id`` has a NULL component and is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import staged
from symgrid.llm.components import components
from symgrid.llm.shingles import mix, shingle_sets

BANDS, ROWS = 32, 5
#: Minima of each text; the first BANDS * ROWS make the bands, all of them the estimate.
PERMUTATIONS = 640
BITS = 2
#: Similarity in hundredths at which texts are linked.
THRESHOLD = 80
#: Pairs whose estimate is further below the threshold than this are not confirmed: 4.5 standard deviations of it.
MARGIN = 0.085
#: A group is compared pair by pair up to the square of this many comparisons.
CROWD = 64
#: Sets whose sizes differ by less than this factor share a size class.
CLASS = 1.06
#: A shingle that makes up this share of all shared ones is known to every task; so there are as many at most.
HOT_SHARE = 4096
#: Bits of a bitmap of ids: 4 MB.
ID_BITS = 1 << 25

_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(1, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RNG.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_BAND_FACTORS = _RNG.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_SHIFTS = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_AT_ONCE = 1024
#: Texts hashed at a time.
_TEXTS = 256

FINGERPRINTS = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, low_bits array<long>"


def minima(shingles: np.ndarray) -> np.ndarray:
    narrow = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(narrow), _AT_ONCE):
        part = narrow[at : at + _AT_ONCE, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    return mix((rows * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SHIFTS).view(np.int64)


def low_bits(least: np.ndarray) -> np.ndarray:
    """The lowest BITS bits of a hash of each minimum, packed into 64-bit integers.

    Those of the minimum itself follow from the lowest bits of its shingle alone, so chance would not average out over permutations.
    """
    bits = (mix(least.astype(np.uint64))[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").view(np.int64)


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _TEXTS):
                part = batch.iloc[at : at + _TEXTS]
                rows = []
                for doc_id, shingles in zip(part["doc_id"].astype("object"), shingle_sets(list(part["text"]), shingle_words), strict=True):
                    least = minima(shingles)
                    found = len(shingles) > 0
                    rows.append((
                        None if pd.isna(doc_id) else int(doc_id), len(shingles),
                        int(mix(shingles).sum(dtype=np.uint64).view(np.int64)),
                        int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)),
                        band_keys(least) if found else [], low_bits(least) if found else [],
                    ))
                frame = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_a", "set_b", "bands", "low_bits"])
                yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, FINGERPRINTS)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: the share of equal groups of bits, less those equal by chance."""
    words = PERMUTATIONS * BITS // 64
    mask = sum(1 << (BITS * k) for k in range(64 // BITS))
    mask -= (mask >> 63) << 64
    different = []
    for k in range(words):
        apart = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        folded = reduce(lambda x, y: x.bitwiseOR(y), [F.shiftrightunsigned(apart, bit) for bit in range(BITS)])
        different.append(F.bit_count(folded.bitwiseAND(F.lit(mask).cast("long"))))
    share = 1 - reduce(lambda x, y: x + y, different) / PERMUTATIONS
    chance = 1 / (1 << BITS)
    return (share - chance) / (1 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle_words: int, threshold: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for at in range(0, len(batch), _TEXTS):
                part = batch.iloc[at : at + _TEXTS]
                mine = shingle_sets(list(part["text_u"]), shingle_words)
                # An id that is repeated has several texts, so a text is known by both.
                right_texts = list(zip(part["v"], part["text_v"], strict=True))
                unseen = list(dict.fromkeys(right_texts))
                others = dict(zip(unseen, shingle_sets([text for _, text in unseen], shingle_words), strict=True))
                for u, right_text, a in zip(part["u"], right_texts, mine, strict=True):
                    v, b = right_text[0], others[right_text]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if both and 100 * both >= threshold * (len(a) + len(b) - both):
                        linked.append((u, v))
            yield pd.DataFrame(linked, columns=["u", "v"], dtype="int64")

    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    return pairs.join(left, "u").join(right, "v").mapInPandas(run, "u long, v long")


def shingle_counts(texts: DataFrame, shingle_words: int) -> DataFrame:
    """(shingle, sets): in how many texts each shingle is, summed within tasks first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _TEXTS):
                together = np.concatenate(list(shingle_sets(list(batch["text"].iloc[at : at + _TEXTS]), shingle_words)))
                shingles, sets = np.unique(together, return_counts=True)
                yield pd.DataFrame({"shingle": shingles.view(np.int64), "sets": sets})

    return texts.select("text").mapInPandas(run, "shingle long, sets long").groupBy("shingle").agg(F.sum("sets").alias("sets"))


def split_sets(texts: DataFrame, hot: np.ndarray, shingle_words: int) -> DataFrame:
    """(node, version, n, cold, hot) of each text: the shingles that are not in ``hot``, and those that are, in its order.

    ``version`` tells the texts of a repeated id apart.
    """
    order = np.argsort(hot)
    known = hot[order]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _TEXTS):
                part, rows = batch.iloc[at : at + _TEXTS], []
                for node, shingles in zip(part["doc_id"], shingle_sets(list(part["text"]), shingle_words), strict=True):
                    version = int(mix(shingles).sum(dtype=np.uint64).view(np.int64))
                    is_hot = np.isin(shingles, known, assume_unique=True)
                    places = np.sort(order[np.searchsorted(known, shingles[is_hot])])
                    rows.append((int(node), version, len(shingles), shingles[~is_hot].view(np.int64), hot[places].view(np.int64)))
                yield pd.DataFrame(rows, columns=["node", "version", "n", "cold", "hot"])

    return texts.select("doc_id", "text").mapInPandas(run, "node long, version long, n long, cold array<long>, hot array<long>")


def sharing_rare_shingles(texts: DataFrame, crowd: DataFrame, shingle_words: int, threshold: int) -> DataFrame:
    """Pairs (u, v) of ``crowd`` nodes in different components that share one of their rarest shingles.

    All pairs that reach the threshold are among them. Sets of x and y shingles reach it only with
    ``common >= threshold * (x + y) / (100 + threshold)`` in common, so of the first ``x - common + 1`` and
    ``y - common + 1`` in any one order they share one; here the order is by the number of sets with the shingle. How many these
    are depends on the other's size, so sets are met by size class: once as the smaller one, in their own class,
    and once in each class in reach as the larger one.

    Shingles of one set alone come first and name no pair, so only their number matters. The most frequent ones come last; they are told
    where the text is read, so no row of them is joined to its count.
    """
    crowded = texts.join(crowd.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    counts = staged(shingle_counts(crowded, shingle_words).where("sets > 1"), "crowd-counts")
    total = counts.agg(F.coalesce(F.sum("sets"), F.lit(0))).first()[0]
    is_hot = F.col("sets") * HOT_SHARE > total
    hot = np.array([row.shingle for row in counts.where(is_hot).orderBy("sets", "shingle").collect()], np.int64).view(np.uint64)
    sets = staged(split_sets(crowded, hot, shingle_words), "crowd-sets")
    shared = (
        sets.select("node", "version", F.explode("cold").alias("shingle"))
        .join(counts.where(~is_hot).hint("merge"), "shingle")
        .groupBy("node", "version")
        .agg(F.expr("array_sort(collect_set(struct(sets, shingle))).shingle").alias("shared"))
    )
    ordered = sets.join(shared, ["node", "version"], "left").select(
        "node", "n", (F.size("cold") - F.coalesce(F.size("shared"), F.lit(0))).alias("alone"),
        F.concat(F.coalesce("shared", F.array().cast("array<long>")), "hot").alias("shingles"),
    )
    size_class = "CAST(floor(ln({}) / " + repr(math.log(CLASS)) + ") AS INT)"
    own, least = size_class.format("n"), size_class.format(f"greatest(1, n * {threshold} div 100)")
    met = ordered.join(crowd, "node").select(
        "node", "component", "n", "alone", "shingles",
        F.expr(
            f"inline(concat(array(struct({own} AS class, true AS smaller)),"
            f" transform(sequence({least}, {own}), c -> struct(c AS class, false AS smaller))))"
        ),
    )
    common = f"CAST(ceil({threshold} * (n + pow({CLASS}, class) * 0.999999) / {100 + threshold} - 0.000001) AS INT)"
    entries = staged(
        met.select(
            "node", "component", "class", "smaller",
            F.expr(f"explode(slice(shingles, 1, greatest(0, CAST(n AS INT) - {common} + 1 - alone)))").alias("shingle"),
        ),
        "crowd-entries",
    )
    key = ["class", "shingle"]
    several = (
        entries.groupBy(*key, "component").agg(F.count("*").alias("n"))
        .groupBy(*key).agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"))
        .where("parts > 1").drop("parts")
    )
    open_entries = staged(entries.join(several, key), "crowd-open")
    one = open_entries.where("smaller").select(*key, F.col("node").alias("u"), F.col("component").alias("cu"), "largest")
    other = open_entries.where("NOT smaller").select(*key, F.col("node").alias("v"), F.col("component").alias("cv"), F.col("largest").alias("l"))
    outside = one.where("cu <> largest").join(other, key).where("cu <> cv")
    inside = one.where("cu = largest").join(other.where("cv <> l"), key)
    return outside.union(inside.select(outside.columns)).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def parted(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``doc_id`` may be among those of ``ids``: all that are, and a few others; and the rows left.

    Tasks look ids up in a bitmap of fixed size, so the texts that need no look are not moved to find the others. Where it is full,
    more rows come to the exact join that follows.
    """
    place = F.xxhash64(F.col("doc_id").cast("long")).bitwiseAND(F.lit(ID_BITS - 1)) + 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bits = staged(ids.groupBy(bucket.alias("_id_bucket")).agg(F.bitmap_construct_agg(bit).alias("_id_bits")), "id-bits")
    byte = F.conv(F.hex(F.substring("_id_bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    among = F.coalesce(F.bit_get(byte, bit % 8) == 1, F.lit(False))
    marked = docs.join(F.broadcast(bits), bucket == F.col("_id_bucket"), "left")
    columns = [F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]
    return marked.where(among).select(columns), marked.where(~among).select(columns)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    prints = staged(fingerprints(docs, shingle_words), "fingerprints")
    classes = staged(
        prints.where("n_shingles > 0")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("low_bits").alias("low_bits")),
        "classes",
    )
    nodes = classes.where("node IS NOT NULL")
    entry = "struct(i AS number, b AS band, xxhash64(b, bands[(i + 1) % size(bands)]) AS pair)"
    banded = nodes.select("node", F.expr(f"inline(transform(bands, (b, i) -> {entry}))"))
    shared = banded.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last")
    members = staged(banded.join(shared.select("band", "center"), "band"), "band-members")
    candidates = members.select(F.col("node").alias("doc_id")).distinct()
    among, _ = parted(docs.select("doc_id", "text"), candidates)
    texts = staged(among.join(candidates, "doc_id", "left_semi"), "candidate-texts")

    coarse = members.where("center < node").groupBy("node").agg(F.min("center").alias("v")).select(F.col("node").alias("u"), "v")
    closer = members.groupBy("pair").agg(F.min("node").alias("v"), F.max("node").alias("last")).where("v < last")
    fine = members.join(closer, "pair").where("v < node").select(F.col("node").alias("u"), "v")
    first = coarse.union(fine).distinct()
    links = staged(confirmed(first, texts, shingle_words, threshold), "links")
    groups = staged(components(links), "components")

    sizes = nodes.select("node", "n_shingles", "bands", "low_bits")
    placed = (
        members.select("band", "number", "node")
        .join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    counts = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
    open_bands = (
        counts.groupBy("band")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"),
            (F.sum("n") * (F.sum("n") - F.max("n")) > CROWD * CROWD).alias("crowded"),
        )
        .where("parts > 1")
        .select("band", "largest", "crowded")
    )
    still = staged(placed.join(open_bands, "band").join(sizes, "node"), "open-bands")
    few = still.where("NOT crowded")
    a, b = few.where("component <> largest").alias("a"), few.alias("b")
    similar = (100 * F.least("a.n_shingles", "b.n_shingles") >= threshold * F.greatest("a.n_shingles", "b.n_shingles")) & (
        estimate(F.col("a.low_bits"), F.col("b.low_bits")) >= threshold / 100 - MARGIN
    )
    apart = (
        (F.col("a.band") == F.col("b.band"))
        & (F.col("a.component") != F.col("b.component"))
        & ((F.col("b.component") == F.col("b.largest")) | (F.col("a.node") < F.col("b.node")))
        & similar
        # Of the bands that a pair shares, the first one names it.
        & F.expr("array_position(zip_with(a.bands, b.bands, (x, y) -> x = y), true) = a.number + 1")
    )
    second = a.join(b, apart).select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()
    crowd = staged(still.where("crowded").select("node", "component").distinct(), "crowd")
    if crowd.head(1):
        by = sizes.select("node", "n_shingles", "low_bits")
        rare = sharing_rare_shingles(texts, crowd, shingle_words, threshold)
        rare = rare.join(by.alias("a"), F.col("u") == F.col("a.node")).join(by.alias("b"), F.col("v") == F.col("b.node"))
        second = second.union(rare.where(similar).select("u", "v")).distinct()
    more = staged(confirmed(second, texts, shingle_words, threshold), "links")
    of = groups.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    across = (
        more.join(groups.withColumnsRenamed({"node": "u", "component": "cu"}), "u", "left")
        .join(of, "v", "left")
        .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    )
    merged = components(across).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    final = groups.join(merged, "component", "left").select("node", F.coalesce("whole", "component").alias("whole"))
    single = merged.select(F.col("component").alias("node"), "whole")
    named = staged(final.union(single).groupBy("node").agg(F.min("whole").alias("component_id")), "named")

    by_set = classes.join(named, "node", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component_id", "node").alias("component_id")
    )
    joined = prints.select("doc_id", "n_shingles", "set_a", "set_b").join(by_set, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, whole: of each component those of its smallest ``doc_id``, repeated rows once.

    Rows of one id, or of no id, are repeated if their texts are the same; which of them stays is open.
    """
    judged = staged(near_duplicates(docs, shingle_words, threshold).select("doc_id", "kept"), "near-duplicates")
    columns = [F.col("`" + name.replace("`", "``") + "`") for name in docs.columns]
    gone = judged.where("NOT kept").select("doc_id").distinct()
    among, others = parted(docs, gone)
    kept = others.union(among.join(gone, "doc_id", "left_anti").select(columns))
    repeated = judged.where("kept").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("repeated_id"))
    if not repeated.head(1):
        return kept
    among, others = parted(kept, repeated.select(F.col("repeated_id").alias("doc_id")))
    several = F.col("doc_id").eqNullSafe(F.col("repeated_id"))
    once = among.join(repeated, several, "left_semi").dropDuplicates(["doc_id", "text"])
    return others.union(among.join(repeated, several, "left_anti")).union(once)
