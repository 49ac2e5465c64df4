"""Sparse-break markers: which records start a new run of first labels in stored order.

Records are sorted by key, so a run of ``key_1`` is simply all records with that label
and its first record is the smallest in stored order. A stored symbol has the mark as a column, set as its records are sorted. Here
is the same for any records, in one pass over their source: the records of a label are dealt into groups by
the rest of their key, the first of each group stands for it, and the first of these is the first of the label. A label that holds
most of the rows is spread over all tasks in the first step, and has one row per group in the second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BREAK = "first_of_run"


def with_breaks(records: DataFrame, keys: Sequence[str], order: Sequence[str], symbol: str) -> DataFrame:
    """Add ``first_of_run``. Reading it fails where a key is repeated or a first label has several ranks.

    All of it hangs on that column, so Spark drops it where it is not used.
    """
    groups = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [name for name in order if name not in ("key_1", "rank_1")]
    in_order = [name for name in order if name != "key_1"]
    here = F.struct(*keys)

    in_group = Window.partitionBy("key_1", "group").orderBy(*in_order)
    salted = records.withColumn("group", F.pmod(F.xxhash64(*rest), F.lit(groups)).cast("int"))
    grouped = salted.withColumn("before", F.lag(here).over(in_group)).withColumn("nth", F.row_number().over(in_group))
    # Firsts of groups come together by label; all others stay with their group.
    firsts = F.when(F.col("nth") == 1, F.lit(-1)).otherwise(F.col("group"))
    of_label = Window.partitionBy("key_1", "lead").orderBy(*in_order)
    marked = grouped.withColumn("lead", firsts).withColumn("place", F.row_number().over(of_label))

    repeated = F.concat(F.lit(f"Duplicate key in symbol '{symbol}': "), F.concat_ws(", ", *keys))
    mark = F.when(F.col("before") == here, F.raise_error(repeated).cast("boolean"))
    if "rank_1" in order:
        # A label with two ranks would stand in two places of the stored order.
        marked = marked.withColumn("other_rank", F.lag("rank_1").over(of_label)).withColumn("group_rank", F.lag("rank_1").over(in_group))
        clash = F.concat(F.lit("Label with more than one rank: "), "key_1")
        for other in ("other_rank", "group_rank"):
            differs = F.col("place" if other == "other_rank" else "nth").cast("int") > 1
            mark = mark.when(differs & ~F.col(other).eqNullSafe(F.col("rank_1")), F.raise_error(clash).cast("boolean"))
    mark = mark.otherwise((F.col("lead") == -1) & (F.col("place") == 1))
    return marked.select(*records.columns, mark.alias(BREAK))
