"""Driver queries of the operators in this folder, with their oracle SQL where there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.llm import (
    bestfit,
    conv_quality,
    decontaminate,
    lattice,
    lexical,
    licences,
    minhash,
    packing,
    phrases,
    pii,
    quality_rules,
    runindex,
    secrets,
)
from symgrid.llm.common import documents, remainder


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    learned = labels.where(remainder(F.col("doc_id"), 3) != 1)
    network = conv_quality.train(conv_quality.training_sample(docs, learned))
    scored = docs.select(
        "doc_id",
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        conv_quality.quality_score(F.col("text"), network).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _digest(spans: str, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined in the order they come in."""
    chosen = F.filter(spans, lambda span: span.kind.isin(*kinds))
    return F.array_join(F.transform(chosen, lambda span: F.concat_ws(":", span.kind, span.start, span.end)), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span.kind == kind)).cast("long").alias(f"n_{kind}")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", pii.personal_spans(F.col("text")).alias("found"))
    base = ("email", "ip", "card", "phone")
    return found.select(
        "doc_id", *(_count("found", kind) for kind in base), F.sha2(_digest("found", base), 256).alias("base_sha256"),
        _digest("found", pii.KINDS).alias("spans"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", secrets.secret_spans(F.col("text")).alias("found"))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id", *(_count("found", kind) for kind in base), F.sha2(_digest("found", base), 256).alias("base_sha256"),
        _digest("found", secrets.KINDS).alias("spans"),
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle_words=4)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = remainder(F.col("doc_id"), 5) == 1
    return lattice.score_texts(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(documents(spark, sf_dir))


def op9_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate.mark_contamination(documents(spark, sf_dir).select("doc_id", "text"), benchmark, "found")
    items = F.transform("found.items", lambda item: item.cast("string"))
    hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda total, run: total + run.end - run.start)
    return marked.select(
        "doc_id", F.col("found.n_words"), hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.best_fit(documents(spark, sf_dir)).drop("ids")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_secrets": op5_secrets,
    "op6_minhash": op6_minhash,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_licences": op8_licences,
    "op9_run_index": op9_run_index,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_phrases": op12_phrases,
    "op13_best_fit": op13_best_fit,
}

ORACLE = {
    "op3_quality_rules": quality_rules.SQL,
    "op10_decontamination": decontaminate.SQL,
    "op11_lexical_search": lexical.SQL,
    "op12_phrases": phrases.SQL,
}
