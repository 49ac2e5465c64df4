"""What several operators share: reading columns safely, staging tables, splitting words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.sources.shared import new_folder

#: A word is a run of anything but these. ``bytes.split()`` splits on the same six bytes.
BLANKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda word: word != "")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once under the shared folder and read again: computed once, safe against lost executors."""
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def staged_by(df: DataFrame, purpose: str, key: str, parts: int) -> DataFrame:
    """As ``staged``, in ``parts`` buckets of ``key``: grouping by it or joining on it doesn't move these rows again.

    Buckets are known by a table's name only, so the folder is a table while it is written and opened.
    """
    spark = df.sparkSession
    name = f"symgrid_{uuid.uuid4().hex}"
    try:
        df.write.format("parquet").bucketBy(parts, key).sortBy(key).option("path", new_folder(spark, purpose)).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo: the folds that queries learn from or hold out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def sampled_ids(ids: DataFrame, size: int) -> DataFrame:
    """At most ``size`` distinct values of ``doc_id``, those of lowest hash.

    A count decides which share of hashes is looked at, so that no more than about twice the
    sample is sorted, however many rows there are.
    """
    share = max(1, ids.count() // (2 * size))
    key = F.xxhash64("doc_id")
    few = ids.where(F.col("doc_id").isNotNull() & (F.pmod(key, F.lit(share)) == 0)).select("doc_id").distinct()
    return few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
