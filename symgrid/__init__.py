"""Named, multi-dimensional sparse symbols as Spark DataFrames."""

from symgrid.operators.catalog import preload, require_symbol, symbols
from symgrid.operators.domains import domain_values
from symgrid.operators.read import read_symbol
from symgrid.sources.session import SymbolSet
from symgrid.sources.store import SymbolStore
from symgrid.sources.writing import write_alias, write_parameter, write_set, write_symbol

__all__ = [
    "SymbolSet",
    "SymbolStore",
    "domain_values",
    "preload",
    "read_symbol",
    "require_symbol",
    "symbols",
    "write_alias",
    "write_parameter",
    "write_set",
    "write_symbol",
]
