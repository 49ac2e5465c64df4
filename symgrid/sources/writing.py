"""Writing symbols into a store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from symgrid.model import SymbolMeta
from symgrid.sources.store import SymbolStore


def _store(spark: SparkSession, store: str | SymbolStore) -> SymbolStore:
    return store if isinstance(store, SymbolStore) else SymbolStore(spark, store)


def write_symbol(
    df: DataFrame,
    store: str | SymbolStore,
    name: str,
    symbol_type: int | str,
    dims: Sequence[str | Column],
    values: str | Column | Mapping[str, str | Column] | None = None,
    domain_labels: Sequence[str] | None = None,
    description: str = "",
    label_rank: Mapping | None = None,
    mode: str = "error",
    num_partitions: int | None = None,
    build_domains: bool = True,
) -> SymbolMeta:
    """Write ``df`` as a symbol; creates the store if needed.

    ``dims`` are the key columns, ``values`` maps value column names to columns
    (a bare column fills the first value column, for a set the element text).
    Records are stored sorted by key, labels in byte order; ``label_rank`` maps a
    dimension (its column or 1-based position) to a column with the rank of its label
    where another order is wanted. NULL labels and repeated keys fail the write.
    ``mode='overwrite'`` replaces a symbol of that name.

    ``df`` is evaluated once, into a staging folder beside the symbol that is removed after the
    write, so a source that gives other records each time is stored consistently. Labels are trimmed of
    white space; blank ones fail, as do a label with several ranks or none where ranks are given.
    """
    return _store(df.sparkSession, store).write(
        df, name, symbol_type, dims, values, domain_labels, description, label_rank, mode, num_partitions, build_domains
    )


def write_set(
    df: DataFrame,
    store: str | SymbolStore,
    name: str,
    description: str,
    element: str | Column,
    text: str | Column | None = None,
    rank: str | Column | None = None,
    **options,
) -> SymbolMeta:
    """Write a one-dimensional set; ``rank`` gives the order of its elements."""
    label_rank = None if rank is None else {1: rank}
    return write_symbol(
        df, store, name, "Set", [element], text, description=description, label_rank=label_rank, **options
    )


def write_parameter(
    df: DataFrame,
    store: str | SymbolStore,
    name: str,
    description: str,
    dims: Sequence[str | Column],
    value: str | Column,
    **options,
) -> SymbolMeta:
    """Write a parameter: keys of any number of dimensions and one value."""
    return write_symbol(df, store, name, "Parameter", dims, value, description=description, **options)


def write_alias(
    spark: SparkSession, store: str | SymbolStore, name: str, target: str, mode: str = "error"
) -> SymbolMeta:
    """Add another name for a symbol to the catalog."""
    return _store(spark, store).write_alias(name, target, mode)
