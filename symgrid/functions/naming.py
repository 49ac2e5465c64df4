"""Column naming: which columns a symbol has, and what they are called."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

# Symbol type codes of the data model and their names.
TYPE_NAMES = {
    0: "Set",
    1: "Parameter",
    2: "Variable",
    3: "Equation",
    4: "Alias",
}

# Value columns of each symbol type, with their Spark SQL types.
VALUE_COLUMNS = {
    "Set": (("is_member", "boolean"), ("description", "string")),
    "Parameter": (("value", "double"),),
    "Variable": (
        ("level", "double"),
        ("marginal", "double"),
        ("lower", "double"),
        ("upper", "double"),
        ("scale", "double"),
    ),
    "Equation": (
        ("level", "double"),
        ("marginal", "double"),
        ("lower", "double"),
        ("upper", "double"),
        ("scale", "double"),
    ),
    "Unknown": (("value", "double"),),
}

# Names of the two marker columns of symbols with 2+ dimensions.
MARKER_COLUMNS = ("is_sparse_break", "is_dense_run")

UNDECLARED = "*"


def type_name(symbol_type: int | str) -> str:
    """Name of a symbol type given as a code or as a name in any case. Unknown codes have a name of their own."""
    if isinstance(symbol_type, str):
        known = {n.lower(): n for n in (*TYPE_NAMES.values(), "Unknown")}
        if symbol_type.strip().lower() not in known:
            raise ValueError(f"Unknown symbol type '{symbol_type}'")
        return known[symbol_type.strip().lower()]
    return TYPE_NAMES.get(symbol_type, "Unknown")


def value_columns(symbol_type: int | str) -> tuple[str, ...]:
    """Value column names of a symbol type, in output order."""
    return tuple(name for name, _ in VALUE_COLUMNS.get(type_name(symbol_type), ()))


def is_declared(label: str | None) -> bool:
    return bool(label) and label != UNDECLARED


def unique_names(names: Iterable[str]) -> list[str]:
    """Give later namesakes the suffixes ``_1``, ``_2``, ... in order of appearance.

    Names that differ only in case count as the same name, because Spark
    resolves columns case-insensitively and refuses to write such a pair.
    """
    taken: set[str] = set()
    result = []
    for name in names:
        unique, suffix = name, 0
        while unique.lower() in taken:
            suffix += 1
            unique = f"{name}_{suffix}"
        taken.add(unique.lower())
        result.append(unique)
    return result


def symbol_columns(domain_labels: Sequence[str], values: Sequence[str]) -> list[str]:
    """Output column names: dimensions, then markers (2+ dimensions), then values."""
    dimensions = [
        label if is_declared(label) else f"dim_{position}"
        for position, label in enumerate(domain_labels, start=1)
    ]
    markers = MARKER_COLUMNS if len(dimensions) > 1 else ()
    return unique_names([*dimensions, *markers, *values])
