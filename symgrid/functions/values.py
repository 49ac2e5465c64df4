"""Value expressions. All are built-in column expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def special_to_null(value: Column) -> Column:
    """A double with NaN and the infinities (the special values) turned into NULL."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def element_text(text: Column) -> Column:
    """Text of a set element; an empty text is NULL."""
    text = text.cast("string")
    return F.when(F.length(text) > 0, text)


def membership(slot: Column | None = None) -> Column:
    """TRUE for each record present; NULL where the numeric slot is special."""
    if slot is None:
        return F.lit(True)
    return F.when(special_to_null(slot).isNotNull(), F.lit(True))


def fail_when(condition: Column, message: str | Column) -> Column:
    """A filter condition that keeps every row and fails the job where ``condition`` holds."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))


def same_label(key: Column, label: str, ignore_case: bool = False) -> Column:
    """Whether a key is this label, in any spelling if case is ignored."""
    return F.lower(key) == F.lower(F.lit(label)) if ignore_case else key == label
