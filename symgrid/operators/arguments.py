"""Validation of scan arguments. Works on names and catalog rows only, never on records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from symgrid.functions.naming import is_declared
from symgrid.functions.records import WHITE
from symgrid.model import SymbolMeta

# Messages that users match on. The SQL functions raise the same ones.
NULL_FILTER = "dimension_filters may not contain NULL keys or values"
BLANK_KEY = "dimension_filters keys must contain at least one non-whitespace character"
BLANK_VALUE = "dimension_filters values must contain at least one non-whitespace character"
DUPLICATE_FILTER = "Duplicate dimension filter supplied for '{}'"
UNKNOWN_DIMENSION = "Unknown dimension '{}' supplied via dimension_filters parameter. Valid dimensions: {}"
NO_DIMENSION = "Dimension '{}' not found in symbol '{}'. Available dimensions: {}"
OUT_OF_RANGE = "Dimension index {} out of range for symbol '{}' (has {} dimensions)"
NULL_VALUE_COLUMN = "value_columns may not contain NULL entries"
UNKNOWN_VALUE = "Unknown value column '{}' for symbol '{}'"
DUPLICATE_VALUE = "Duplicate value column '{}' in value_columns parameter"
NO_SYMBOL_NAME = "symbol parameter to preload cannot be NULL"


def _folded(text: str) -> str:
    return text.strip(WHITE).lower()


def _filter_items(dimension_filters) -> list[tuple[str, str]]:
    """Trimmed (key, value) pairs after the checks on the argument itself."""
    if dimension_filters is None:
        return []
    if not isinstance(dimension_filters, Mapping):
        raise ValueError("dimension_filters must be provided as a mapping of strings to strings")
    if any(key is None or value is None for key, value in dimension_filters.items()):
        raise ValueError(NULL_FILTER)
    if not all(isinstance(text, str) for item in dimension_filters.items() for text in item):
        raise ValueError("dimension_filters keys and values must be strings")
    items = [(key.strip(WHITE), value.strip(WHITE)) for key, value in dimension_filters.items()]
    if not all(key for key, _ in items):
        raise ValueError(BLANK_KEY)
    if not all(value for _, value in items):
        raise ValueError(BLANK_VALUE)
    return items


def dimension_aliases(meta: SymbolMeta) -> dict[str, int]:
    """Every name a dimension answers to, folded, with its 0-based position.

    Output column names win over labels, so a label carried by several
    dimensions means the one whose column has exactly that name.
    """
    aliases = {_folded(name): i for i, name in enumerate(meta.dimension_names)}
    for i, label in enumerate(meta.domain_labels):
        if is_declared(label):
            aliases.setdefault(_folded(label), i)
        else:
            aliases.setdefault(f"dim_{i + 1}", i)
            if meta.dimension_count == 1:
                aliases.setdefault(_folded(meta.name), i)
    return aliases


def resolve_filters(meta: SymbolMeta, dimension_filters) -> list[tuple[int, str]]:
    """(0-based dimension, label) pairs to AND together."""
    aliases = dimension_aliases(meta)
    resolved: dict[int, str] = {}
    for key, value in _filter_items(dimension_filters):
        position = aliases.get(_folded(key))
        if position is None:
            raise ValueError(UNKNOWN_DIMENSION.format(key, ", ".join(meta.dimension_names)))
        if position in resolved:
            raise ValueError(DUPLICATE_FILTER.format(meta.dimension_names[position]))
        resolved[position] = value
    return list(resolved.items())


def resolve_dimension(meta: SymbolMeta, dimension: int | str) -> int:
    """0-based position of a dimension given by 1-based index or by name."""
    if isinstance(dimension, str):
        position = dimension_aliases(meta).get(_folded(dimension))
        if position is None:
            raise ValueError(NO_DIMENSION.format(dimension, meta.name, ", ".join(meta.dimension_names)))
        return position
    if isinstance(dimension, bool) or not isinstance(dimension, int):
        raise ValueError("dimension must be a name or a 1-based index")
    if not 1 <= dimension <= meta.dimension_count:
        raise ValueError(OUT_OF_RANGE.format(dimension, meta.name, meta.dimension_count))
    return dimension - 1


def chosen_values(meta: SymbolMeta, requested: Sequence[str] | None) -> list[str]:
    """Value columns to return, in the requested order; all of them by default."""
    if requested is None:
        return list(meta.values)
    if isinstance(requested, str) or not isinstance(requested, Sequence):
        raise ValueError("value_columns must be provided as a list of strings")
    chosen: list[str] = []
    for name in requested:
        if name is None:
            raise ValueError(NULL_VALUE_COLUMN)
        if not isinstance(name, str):
            raise ValueError("value_columns entries must be strings")
        if name not in meta.values:
            raise ValueError(UNKNOWN_VALUE.format(name, meta.name))
        if name in chosen:
            raise ValueError(DUPLICATE_VALUE.format(name))
        chosen.append(name)
    return chosen or list(meta.values)


def checked_count(value: int | None, what: str) -> int | None:
    """A row offset or limit; None when not given."""
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{what} must be an integer")
    if value < 0:
        raise ValueError(f"{what} must be non-negative")
    return value
