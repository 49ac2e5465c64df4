"""Symbol catalog: listing, existence check, preload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from symgrid.model import CATALOG_COLUMNS, SymbolMeta
from symgrid.operators.arguments import NO_SYMBOL_NAME
from symgrid.sources.containers import Container, open_container


def symbols(spark: SparkSession, source: str | Container) -> DataFrame:
    """One row per symbol of the container, aliases included, in the order they were added."""
    container = open_container(spark, source)
    return container.catalog().orderBy("symbol_index").select(*CATALOG_COLUMNS)


def require_symbol(spark: SparkSession, source: str | Container, symbol: str) -> SymbolMeta:
    """Metadata of a symbol, matched ignoring case; an error if there is none."""
    return open_container(spark, source).find(symbol)


_NOT_GIVEN = object()


def preload(
    spark: SparkSession,
    source: str | Container,
    symbol: str | None = _NOT_GIVEN,
    force_reload: bool = False,
) -> None:
    """Load the symbol list of a container now, and check that ``symbol`` is in it.

    The list is loaded on first use anyway and kept for the application. It is not
    checked for changes made by other applications: ``force_reload`` drops it first.
    """
    if symbol is None:
        raise ValueError(NO_SYMBOL_NAME)
    from symgrid.sources.store import SymbolStore

    container = SymbolStore(spark, source) if isinstance(source, str) else source
    container.reload(force_reload)
    if symbol is not _NOT_GIVEN:
        container.find(symbol)
