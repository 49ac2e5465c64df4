"""Symbol metadata."""

from __future__ import annotations

from dataclasses import dataclass

from symgrid.functions.naming import symbol_columns, value_columns
from symgrid.functions.records import key_columns

# Columns of the catalog and their types.
CATALOG_COLUMNS = {
    "symbol_name": "string",
    "symbol_type": "string",
    "dimension_count": "bigint",
    "record_count": "bigint",
    "description": "string",
    "domain_labels": "array<string>",
}
CATALOG_DDL = ", ".join(f"{name} {kind}" for name, kind in CATALOG_COLUMNS.items())


@dataclass(frozen=True)
class SymbolMeta:
    """What the catalog knows about one symbol."""

    name: str
    symbol_type: str
    domain_labels: tuple[str, ...]
    description: str = ""
    index: int = 0
    record_count: int | None = None
    revision: int = 0
    ranked: tuple[int, ...] = ()
    folder: str = ""

    @property
    def dimension_count(self) -> int:
        return len(self.domain_labels)

    @property
    def keys(self) -> list[str]:
        return key_columns(self.dimension_count)

    @property
    def values(self) -> tuple[str, ...]:
        return value_columns(self.symbol_type)

    @property
    def dimension_names(self) -> list[str]:
        """Output names of the dimensions; they do not depend on the value columns."""
        return symbol_columns(self.domain_labels, ())[: self.dimension_count]


def checked_labels(dimension_count: int, domain_labels) -> tuple[str, ...]:
    """Domain labels of a new symbol; ``*`` for each dimension left undeclared."""
    if domain_labels is None:
        return ("*",) * dimension_count
    labels = tuple(label or "*" for label in domain_labels)
    if len(labels) != dimension_count:
        raise ValueError(f"{len(labels)} domain labels given for {dimension_count} dimensions")
    return labels
