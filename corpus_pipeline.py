"""A training corpus from ``documents``: filtered, deduplicated, decontaminated, redacted and packed.

Each stage is a function of (spark, docs, sf_dir) that works on everything its predecessor kept. A
stage's result is written as Parquet under the shared folder and read again by the next one, so a
lost executor costs no more than a part of a stage.

* quality_rules: documents that fail the base rules or the fences of their language and source go;
* near_duplicates: of each group of near duplicates (five-word shingles, similarity 0.8) the smallest id stays;
* decontamination: documents with a passage of the benchmark go;
* secrets: documents stay, their secrets are replaced by a placeholder;
* packing: one row per piece of a document in a training sequence.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.llm import decontaminate, minhash, packing, quality_rules, secrets
from symgrid.llm.common import documents, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.good_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the similarity groups nor the token ids; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
