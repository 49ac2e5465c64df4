"""Order statistics: the keys at given row numbers of a table in key order, without sorting it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Splitters of a round, and rows that a range may have to be sorted.
SPLITTERS = 64
SORTED = 200_000


def _struct(table: DataFrame, order: Sequence[str], key: Row) -> Column:
    kinds = dict(table.dtypes)
    return F.struct(*[F.lit(key[name]).cast(kinds[name]).alias(name) for name in order])


def not_before(table: DataFrame, order: Sequence[str], key: Row) -> Column:
    """Rows whose key is not below ``key``. The first column is compared by itself too, so that it prunes a scan."""
    condition = F.struct(*order) >= _struct(table, order, key)
    return condition if key[order[0]] is None else condition & (F.col(order[0]) >= key[order[0]])


def not_after(table: DataFrame, order: Sequence[str], key: Row) -> Column:
    """Rows whose key is not above ``key``."""
    return F.struct(*order) <= _struct(table, order, key)


def with_range(table: DataFrame, name: str, order: Sequence[str], bounds: str, count: int) -> DataFrame:
    """Add how many of at most ``count`` sorted bounds, an array in column ``bounds``, are not above the key of a row.

    By halving: one column per step, since each is used twice by the next; the steps run in one generated loop.
    """
    key, found = F.struct(*order), F.lit(0)
    for bit in reversed(range(count.bit_length())):
        step = 1 << bit
        # Beyond the end there is NULL, which is not reached.
        table = table.withColumn(name, found + F.when(F.get(bounds, found + (step - 1)) <= key, step).otherwise(0))
        found = F.col(name)
    return table if count else table.withColumn(name, found)


def key_at(table: DataFrame, order: Sequence[str], row: int) -> Row | None:
    """The key of a row number (from 0) in the order of unique keys; None beyond the last.

    Rounds: SPLITTERS keys drawn by hash cut what is left into ranges, one aggregate counts them, and the one that holds the row is
    left, until it is small enough to be sorted. A round leaves about 1 / SPLITTERS of the rows; the driver sees the splitters only.
    """
    keys = table.select(*order)
    here = F.struct(*order)
    inside, rows = keys, keys.count()
    if row >= rows:
        return None
    while rows > SORTED:
        drawn = inside.where(F.pmod(F.xxhash64(*order), F.lit(max(1, rows // (4 * SPLITTERS)))) == 0)
        bounds = drawn.distinct().orderBy(F.xxhash64(*order, F.lit(rows))).limit(SPLITTERS).orderBy(*order).collect()
        if not bounds:
            break
        local = table.sparkSession.createDataFrame([(bounds,)], StructType().add("bounds", ArrayType(keys.schema)))
        placed = with_range(inside.withColumn("bounds", local.scalar()), "at", order, "bounds", len(bounds))
        counts = dict(placed.groupBy("at").count().collect())
        place = before = 0
        while row >= before + counts.get(place, 0):
            before += counts.get(place, 0)
            place += 1
        if counts[place] == rows:
            break
        if place > 0:
            inside = inside.where(not_before(keys, order, bounds[place - 1]))
        if place < len(bounds):
            inside = inside.where(here < _struct(keys, order, bounds[place]))
        row, rows = row - before, counts[place]
    return inside.orderBy(*order).limit(row + 1).orderBy(*[F.desc(name) for name in order]).first()
