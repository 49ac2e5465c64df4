"""From any DataFrame to the record form shared by every symbol.

Record columns: ``key_1 .. key_n`` (labels), ``rank_i`` for each dimension whose
labels have a declared order, and the value columns of the symbol type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.functions.naming import VALUE_COLUMNS
from symgrid.functions.values import element_text, fail_when, membership, special_to_null

#: White space around labels, filter keys and filter values does not count: the same six characters everywhere.
WHITE = " \t\n\x0b\x0c\r"


def as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def key_columns(dimension_count: int) -> list[str]:
    return [f"key_{i}" for i in range(1, dimension_count + 1)]


def order_columns(dimension_count: int, ranked: Sequence[int] = ()) -> list[str]:
    """Columns that define the stored order: per dimension its rank (if any), then its label."""
    order = []
    for i in range(1, dimension_count + 1):
        if i in ranked:
            order.append(f"rank_{i}")
        order.append(f"key_{i}")
    return order


def ranked_dimensions(dims: Sequence[str | Column], label_rank: Mapping | None) -> dict[int, str | Column]:
    """``label_rank`` keyed by 1-based dimension; its keys may be positions or dim columns."""
    ranked = {}
    for key, rank in (label_rank or {}).items():
        names = [d if isinstance(d, str) else None for d in dims]
        position = names.index(key) + 1 if isinstance(key, str) and key in names else key
        if not isinstance(position, int) or not 1 <= position <= len(dims):
            raise ValueError(f"label_rank names an unknown dimension {key!r}")
        ranked[position] = rank
    return ranked


def _value_expression(symbol_type: str, name: str, supplied: Mapping[str, Column]) -> Column:
    if name == "is_member":
        return membership(supplied.get(name))
    if name not in supplied:
        return F.lit(None).cast(dict(VALUE_COLUMNS[symbol_type])[name])
    if name == "description":
        return element_text(supplied[name])
    return special_to_null(supplied[name])


def to_records(
    df: DataFrame,
    symbol_type: str,
    dims: Sequence[str | Column],
    values: str | Column | Mapping[str, str | Column] | None = None,
    label_rank: Mapping | None = None,
    symbol: str = "",
    clean_labels: bool = False,
) -> DataFrame:
    """Records of a symbol from ``df``. White space around labels is dropped; reading a NULL or blank label fails.

    ``values`` maps value column names to columns of ``df``; a bare column fills the
    first value column of the type (for a set: the element text). Value columns not
    supplied are NULL. For a set, ``is_member`` may name the numeric slot to test. With ``clean_labels`` keys
    are taken as they are.
    """
    names = [name for name, _ in VALUE_COLUMNS[symbol_type]]
    if values is None:
        values = {}
    elif not isinstance(values, Mapping):
        values = {"description" if symbol_type == "Set" else names[0]: values}
    unknown = [name for name in values if name not in names]
    if unknown:
        raise ValueError(f"Unknown value column '{unknown[0]}' for a symbol of type {symbol_type}")
    supplied = {name: as_column(column) for name, column in values.items()}

    labels = [as_column(dim).cast("string") for dim in dims]
    if not clean_labels:
        labels = [F.btrim(label, F.lit(WHITE)) for label in labels]
    keys = [label.alias(name) for label, name in zip(labels, key_columns(len(dims)), strict=True)]
    ranks = [
        as_column(rank).alias(f"rank_{position}")
        for position, rank in ranked_dimensions(dims, label_rank).items()
    ]
    slots = [_value_expression(symbol_type, name, supplied).alias(name) for name in names]
    records = df.select(*keys, *ranks, *slots)
    for name in () if clean_labels else key_columns(len(dims)):
        key = F.col(name)
        problem = F.when(key.isNull(), f"NULL label in symbol '{symbol}'").otherwise(f"Blank label in symbol '{symbol}'")
        records = records.where(fail_when(key.isNull() | (key == ""), problem))
    return records


def distinct_labels(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct labels of all dimensions in one pass: ``dim_index`` (1-based), ``value``."""
    positions = [str(i) for i in range(1, len(keys) + 1)]
    return (
        records.select(*[F.col(key).alias(position) for key, position in zip(keys, positions, strict=True)])
        .unpivot([], positions, "dim_index", "value")
        .distinct()
        .select(F.col("dim_index").cast("int").alias("dim_index"), "value")
    )
