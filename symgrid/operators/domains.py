"""Distinct labels of one dimension, optionally under filters on other dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.operators.arguments import resolve_dimension, resolve_filters
from symgrid.operators.read import scannable
from symgrid.sources.containers import Container, open_container


def domain_values(
    spark: SparkSession,
    source: str | Container,
    symbol: str,
    dimension: int | str,
    dimension_filters: Mapping[str, str] | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """Labels that occur in a dimension, one column ``value`` in ascending byte order.

    ``dimension`` is a name or a 1-based index. With ``dimension_filters`` only records
    with those labels count, so choices made in some dimensions narrow the others; the
    requested dimension may be filtered too.
    """
    container = open_container(spark, source)
    meta = scannable(container, symbol)
    position = resolve_dimension(meta, dimension)
    filters = resolve_filters(meta, dimension_filters)
    if filters:
        records = container.scan(meta, filters, ignore_case)
        labels = records.select(F.col(meta.keys[position]).alias("value")).distinct()
    else:
        labels = container.labels(meta, position)
    return labels.orderBy("value")
