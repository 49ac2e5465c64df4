"""Quality rules with thresholds that adapt to each language and source.

Counts over every whole text give five rates, whole numbers per thousand. A quantile sketch of
each rate is kept per language and source: a histogram over log-linear buckets (values below 32
have their own, above that each power of two has 16). Two sketches merge by adding counts,
exactly and in any order. The upper fence of a rate is
``median + SPREADS * (median - lower decile) + slack``; the lower half gives the spread, so a
source may be junk to almost a half and still be told apart. A group's fence is blended with that of its
language, as if PRIOR_DOCS documents had it, and the language's with that of all documents in the same way: the fewer documents,
the more it leans on the others, at no size by a jump.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL language or
source is a group of its own; repeated rows are judged one by one; an empty table gives an empty
result; other columns of the input are ignored.

Only DataFrame functions are used. A group's sketches have a few hundred rows whatever its size,
and counts are summed before they are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from symgrid.llm.common import staged, words

#: Each rate with its slack per thousand, which covers the noise of short texts.
RATES = {"symbol_rate": 15, "duplicate_line_rate": 400, "repeat_rate": 180, "capital_rate": 150, "shout_rate": 25}
SPREADS = 4
#: Documents that the fence of the next wider group counts as.
PRIOR_DOCS = 50
MIN_WORDS = 10
WINDOW = 5
#: Percentiles that the fences use.
MEDIAN, DECILE = 50, 10


def rule_counts(docs: DataFrame, *carried: str) -> DataFrame:
    """Counts of each text: words, code points in words, symbols, repeated lines and windows, capitals, shouts.

    Columns named in ``carried`` come along.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        *carried, F.col("lang"), F.col("source"),
        words(text).alias("_words"), lines.alias("_lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("n_capitals"),
        F.regexp_count(text, F.lit("!")).alias("n_shouts"),
    )
    window = ", ".join(f"_words[i + {k}]" for k in range(WINDOW))
    hashed = base.select(
        *carried, "lang", "source", "n_symbols", "n_capitals", "n_shouts",
        F.size("_words").alias("n_words"),
        F.length(F.array_join("_words", "")).alias("word_chars"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.expr(
            f"CASE WHEN size(_words) >= {WINDOW}"
            f" THEN transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({window}))"
            " ELSE array() END"
        ).cast("array<bigint>").alias("_windows"),
    )
    # Windows that occur twice stand side by side once sorted; most texts have none and skip the sort.
    placed = hashed.withColumn(
        "_placed",
        F.expr(
            "CASE WHEN size(array_distinct(_windows)) < size(_windows)"
            " THEN sort_array(transform(_windows, (h, i) -> struct(h, i AS at))) END"
        ),
    ).drop("_windows")
    starts = placed.withColumn(
        "_starts",
        F.expr(
            "sort_array(transform(filter(_placed, (x, i) -> x.h = get(_placed, i - 1).h OR x.h = get(_placed, i + 1).h),"
            " x -> x.at))"
        ),
    ).drop("_placed")
    covered = f"transform(_starts, (at, i) -> least({WINDOW}, coalesce(get(_starts, i + 1) - at, {WINDOW})))"
    return starts.select(
        *carried, "lang", "source",
        *(F.col(name).cast("long") for name in
          ("n_words", "word_chars", "n_symbols", "n_capitals", "n_shouts", "n_lines", "n_dup_lines")),
        F.coalesce(F.expr(f"aggregate({covered}, 0L, (total, x) -> total + x)"), F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def _rate(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"{part} * 1000 div {whole}")).otherwise(F.lit(0).cast("long"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the rates, and whether the base rules fail."""
    return counts.withColumns(
        {
            "symbol_rate": _rate("n_symbols", "word_chars"),
            "duplicate_line_rate": _rate("n_dup_lines", "n_lines"),
            "repeat_rate": _rate("n_repeat_words", "n_words"),
            "capital_rate": _rate("n_capitals", "word_chars"),
            "shout_rate": _rate("n_shouts", "word_chars"),
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        }
    )


def sketches(rated: DataFrame) -> DataFrame:
    """One row per language, source, rate and bucket that occurs: the number of texts in it."""
    pairs = ", ".join(f"'{name}', {name}" for name in RATES)
    values = rated.select("lang", "source", F.expr(f"stack({len(RATES)}, {pairs}) AS (rate, value)"))
    shift = "greatest(length(bin(value)) - 5, 0)"
    bucket = F.expr(f"shiftleft(shiftright(value, {shift}), {shift})")
    return values.groupBy("lang", "source", "rate", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, *group: str) -> DataFrame:
    """Median and lower decile of each rate from merged sketches; a group's window has a few hundred rows at most."""
    merged = sketch.groupBy(*group, "rate", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "rate")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("below", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(whole))
    at = {p: F.min(F.when(100 * F.col("below") >= p * F.col("docs"), F.col("bucket"))) for p in (MEDIAN, DECILE)}
    return ranked.groupBy(*group, "rate").agg(
        F.max("docs").alias("docs"), (at[MEDIAN] + SPREADS * (at[MEDIAN] - at[DECILE])).alias("fence")
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """Upper fences of each rate per language and source, one row each."""
    own = _quantiles(sketch, "lang", "source").withColumnsRenamed({"docs": "own_docs", "fence": "own"})
    by_lang = _quantiles(sketch, "lang").select(F.col("lang").alias("l"), F.col("rate").alias("r"), F.col("docs").alias("lang_docs"), F.col("fence").alias("by_lang"))
    overall = _quantiles(sketch).select(F.col("rate").alias("q"), F.col("fence").alias("overall"))
    joined = own.join(by_lang, own.lang.eqNullSafe(by_lang.l) & (own.rate == by_lang.r), "left").join(
        overall, own.rate == overall.q, "left"
    )
    wider = f"((lang_docs * by_lang + {PRIOR_DOCS} * overall) div (lang_docs + {PRIOR_DOCS}))"
    fence = F.expr(f"(own_docs * own + {PRIOR_DOCS} * {wider}) div (own_docs + {PRIOR_DOCS})")
    return joined.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("rate") == name, fence + slack)).alias(f"max_{name}") for name, slack in RATES.items())
    )


def _judge(docs: DataFrame, carried: str) -> DataFrame:
    """Counts, rates, ``base_failed`` and ``kept`` of every row, with one carried column.

    The counts are staged once, since both the sketches and the filter read them. So are the fences: the planner then
    knows their size before it chooses a join, and need not move the rows if they are few.
    """
    rated = staged(with_rates(rule_counts(docs, carried)), "quality-counts")
    fences = staged(thresholds(sketches(rated)), "quality-fences").withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"})
    joined = rated.join(
        fences, rated.lang.eqNullSafe(fences.fence_lang) & rated.source.eqNullSafe(fences.fence_source), "left"
    )
    within = reduce(lambda x, y: x & y, [F.col(name) <= F.col(f"max_{name}") for name in RATES])
    return joined.withColumn("kept", ~F.col("base_failed") & within)


def judge_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts, rates, ``base_failed`` and ``kept`` of every row."""
    return _judge(docs.select("doc_id", "text", "lang", "source"), "doc_id").drop("fence_lang", "fence_source")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, whole. Rows travel beside their counts, so texts are not joined back."""
    carried = docs.select("text", "lang", "source", F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"))
    return _judge(carried, "_row").where("kept").select("_row.*")


def _sql() -> str:
    """The same in DuckDB's SQL."""
    words_of = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    lines_of = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
    found = "len(regexp_extract_all(coalesce(text, ''), '{}'))"
    window = " || ' ' || ".join(f"ws[i + {k}]" for k in range(WINDOW))
    rate = "CASE WHEN {1} > 0 THEN {0} * 1000 // {1} ELSE 0 END AS {2}"
    shift = "greatest(length(bin(value)) - 5, 0)"

    def quantiles(group: str) -> str:
        keys = f"{group}, " if group else ""
        return (
            f"SELECT {keys}rate, max(docs) AS docs, min(bucket) FILTER (100 * below >= {MEDIAN} * docs) * {1 + SPREADS}"
            f" - {SPREADS} * min(bucket) FILTER (100 * below >= {DECILE} * docs) AS fence FROM ("
            f"SELECT {keys}rate, bucket, sum(n) OVER (PARTITION BY {keys}rate ORDER BY bucket) AS below,"
            f" sum(n) OVER (PARTITION BY {keys}rate) AS docs FROM (SELECT {keys}rate, bucket, sum(n) AS n FROM sketch"
            f" GROUP BY ALL)) GROUP BY {keys}rate"
        )

    wider = f"((b.docs * b.fence + {PRIOR_DOCS} * a.fence) // (b.docs + {PRIOR_DOCS}))"
    blended = f"(o.docs * o.fence + {PRIOR_DOCS} * {wider}) // (o.docs + {PRIOR_DOCS})"
    slack = "CASE o.rate " + " ".join(f"WHEN '{name}' THEN {value}" for name, value in RATES.items()) + " END"
    within = " AND ".join(f"r.{name} <= f.f['{name}'][1]" for name in RATES)
    pairs = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS rate, {name} AS value FROM rated" for name in RATES)
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, {words_of} AS ws, {lines_of} AS ls,
    {found.format('[#*$%&|<>]')} AS n_symbols, {found.format('[A-Z]')} AS n_capitals, {found.format('!')} AS n_shouts
  FROM documents),
places AS (
  SELECT row_id, i, {window} AS w FROM (SELECT row_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM split)),
repeats AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM places) WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT p) AS n FROM (SELECT row_id, unnest(range(i, i + {WINDOW})) AS p FROM repeats) GROUP BY row_id),
counts AS (
  SELECT s.*, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (row_id)),
rated AS (
  SELECT *, {rate.format('n_symbols', 'word_chars', 'symbol_rate')}, {rate.format('n_dup_lines', 'n_lines', 'duplicate_line_rate')},
    {rate.format('n_repeat_words', 'n_words', 'repeat_rate')}, {rate.format('n_capitals', 'word_chars', 'capital_rate')},
    {rate.format('n_shouts', 'word_chars', 'shout_rate')},
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
sketch AS (
  SELECT lang, source, rate, (value >> {shift}) << {shift} AS bucket, count(*) AS n FROM ({pairs}) GROUP BY ALL),
own AS ({quantiles('lang, source')}), by_lang AS ({quantiles('lang')}), overall AS ({quantiles('')}),
fences AS (
  SELECT o.lang, o.source, map(list(o.rate), list({slack} + {blended})) AS f
  FROM own o JOIN by_lang b ON o.lang IS NOT DISTINCT FROM b.lang AND o.rate = b.rate JOIN overall a ON o.rate = a.rate
  GROUP BY o.lang, o.source)
SELECT r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
  NOT r.base_failed AND {within} AS kept
FROM rated r JOIN fences f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
"""


SQL = _sql().replace("f.f['", "element_at(f.f, '").replace("'][1]", "')[1]")
