"""Symbol scan: schema by type and labels, dimension filters, projection, paging, markers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.functions.naming import symbol_columns
from symgrid.model import SymbolMeta
from symgrid.operators.arguments import checked_count, chosen_values, resolve_filters
from symgrid.operators.markers import BREAK
from symgrid.sources.containers import Container, open_container

def scannable(container: Container, symbol: str) -> SymbolMeta:
    """The named symbol, matched ignoring case; aliases hold no records of their own."""
    meta = container.find(symbol)
    if meta.symbol_type == "Alias":
        raise ValueError(f'read_symbol does not support alias symbols: "{meta.name}"')
    return meta


def output_columns(meta: SymbolMeta, values: Sequence[str]) -> list[Column]:
    """The columns of a scan, from those of the records."""
    sources = [F.col(key) for key in meta.keys]
    if meta.dimension_count > 1:
        sources += [F.col(BREAK), ~F.col(BREAK)]
    sources += [F.col(name) for name in values]
    names = symbol_columns(meta.domain_labels, values)
    return [column.alias(name) for column, name in zip(sources, names, strict=True)]


def read_symbol(
    spark: SparkSession,
    source: str | Container,
    symbol: str,
    dimension_filters: Mapping[str, str] | None = None,
    value_columns: Sequence[str] | None = None,
    row_offset: int | None = None,
    row_limit: int | None = None,
    ignore_case: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """All records of one symbol as a DataFrame.

    ``source`` is a store's path or a container. The columns are one string per
    dimension (named by its domain label, ``dim_<N>`` if undeclared), then
    ``is_sparse_break`` and ``is_dense_run`` if there are several dimensions, then the
    value columns of the symbol's type.

    ``dimension_filters`` keeps the records with those labels; ``value_columns`` keeps
    those value columns, in that order. ``row_offset`` and ``row_limit`` cut a page out
    of the filtered records in stored order. A page comes sorted; other scans are in
    no particular order unless ``ordered`` is set, so that they need no shuffle.

    ``ignore_case`` matches labels in any spelling. Marker columns that are not used
    cost nothing: in a stored symbol they are a column, which is pruned, and the windows
    that compute them for a session symbol are removed by the optimizer.
    """
    container = open_container(spark, source)
    meta = scannable(container, symbol)
    filters = resolve_filters(meta, dimension_filters)
    values = chosen_values(meta, value_columns)
    offset = checked_count(row_offset, "offset") or 0
    limit = checked_count(row_limit, "limit")
    paged = bool(offset) or limit is not None

    if paged:
        records = container.page(meta, filters, ignore_case, offset, limit)
    else:
        records = container.scan(meta, filters, ignore_case)
    if ordered or paged:
        records = container.in_order(meta, records, offset, limit)
    return records.select(*output_columns(meta, values))
