"""Opening a container of symbols by path."""

from __future__ import annotations

from pyspark.sql import SparkSession

from symgrid.sources.session import SymbolSet
from symgrid.sources.store import SymbolStore

Container = SymbolSet | SymbolStore


def open_container(spark: SparkSession, source: str | Container) -> Container:
    """The container itself, or the existing store at a path."""
    if isinstance(source, (SymbolSet, SymbolStore)):
        return source
    store = SymbolStore(spark, str(source))
    store.metas()
    return store
