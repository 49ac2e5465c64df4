"""Resolution and validation of scan arguments; no Spark needed."""

import pytest

from symgrid.model import SymbolMeta
from symgrid.operators.arguments import checked_count, chosen_values, resolve_dimension, resolve_filters

TWO = SymbolMeta("d", "Parameter", ("i", "j"))
UNDECLARED = SymbolMeta("Cities", "Set", ("*",))
REPEATED = SymbolMeta("t", "Parameter", ("n", "n", "*"))
SHADOWED = SymbolMeta("s", "Parameter", ("*", "dim_1"))
SCALAR = SymbolMeta("z", "Parameter", ())
VARIABLE = SymbolMeta("x", "Variable", ("i",))


def test_keys_are_trimmed_and_folded_and_values_trimmed():
    assert resolve_filters(TWO, {" I ": " seattle ", "J": "Topeka"}) == [(0, "seattle"), (1, "Topeka")]


def test_nothing_to_filter():
    assert resolve_filters(TWO, None) == resolve_filters(TWO, {}) == resolve_filters(SCALAR, {}) == []


def test_names_an_undeclared_dimension_answers_to():
    for key in ("dim_1", "DIM_1", "cities"):
        assert resolve_filters(UNDECLARED, {key: "a"}) == [(0, "a")]


def test_repeated_label_means_the_column_of_that_name():
    assert resolve_filters(REPEATED, {"n": "a", "n_1": "b", "dim_3": "c"}) == [(0, "a"), (1, "b"), (2, "c")]


def test_column_names_win_over_labels():
    # The first dimension is called dim_1, so the one labelled dim_1 becomes dim_1_1.
    assert SHADOWED.dimension_names == ["dim_1", "dim_1_1"]
    assert resolve_filters(SHADOWED, {"dim_1": "a", "dim_1_1": "b"}) == [(0, "a"), (1, "b")]


@pytest.mark.parametrize(
    ("meta", "filters", "message"),
    [
        (TWO, {"unknown": "a"}, "Unknown dimension 'unknown' .* Valid dimensions: i, j"),
        (TWO, {"d": "a"}, "Unknown dimension 'd'"),
        (TWO, {"dim_1": "a"}, "Unknown dimension 'dim_1'"),
        (SCALAR, {"i": "a"}, "Unknown dimension 'i'"),
        (TWO, {"i": "a", " I": "a"}, "Duplicate dimension filter supplied for 'i'"),
        (UNDECLARED, {"cities": "a", "dim_1": "b"}, "Duplicate dimension filter supplied for 'dim_1'"),
        (TWO, {"i": None}, "NULL keys or values"),
        (TWO, {None: "a"}, "NULL keys or values"),
        (TWO, {"i": 5}, "must be strings"),
        (TWO, {"i": "  "}, "values must contain"),
        (TWO, {" ": "a"}, "keys must contain"),
        (TWO, ["i"], "mapping"),
    ],
)
def test_bad_filters(meta, filters, message):
    with pytest.raises(ValueError, match=message):
        resolve_filters(meta, filters)


def test_dimension_by_index_and_name():
    assert [resolve_dimension(TWO, d) for d in (1, 2, "i", "J")] == [0, 1, 0, 1]
    assert resolve_dimension(REPEATED, "n_1") == 1


@pytest.mark.parametrize("dimension", [0, 3, -1])
def test_dimension_out_of_range(dimension):
    with pytest.raises(ValueError, match=rf"Dimension index {dimension} out of range for symbol 'd' \(has 2 dimensions"):
        resolve_dimension(TWO, dimension)


@pytest.mark.parametrize(("dimension", "message"), [("k", "Dimension 'k' not found in symbol 'd'"), (1.0, "name or"), (True, "name or")])
def test_bad_dimension(dimension, message):
    with pytest.raises(ValueError, match=message):
        resolve_dimension(TWO, dimension)


def test_value_columns_keep_the_requested_order():
    assert chosen_values(VARIABLE, ["upper", "level"]) == ["upper", "level"]
    assert chosen_values(VARIABLE, None) == chosen_values(VARIABLE, []) == list(VARIABLE.values)


@pytest.mark.parametrize(
    ("requested", "message"),
    [
        (["Level"], "Unknown value column 'Level' for symbol 'x'"),
        (["value"], "Unknown value column 'value'"),
        (["level", "level"], "Duplicate value column 'level'"),
        ([None], "NULL entries"),
        ([3], "must be strings"),
        ("level", "list"),
    ],
)
def test_bad_value_columns(requested, message):
    with pytest.raises(ValueError, match=message):
        chosen_values(VARIABLE, requested)


def test_counts():
    assert checked_count(None, "limit") is None
    assert checked_count(0, "limit") == 0
    with pytest.raises(ValueError, match="offset must be non-negative"):
        checked_count(-1, "offset")
    with pytest.raises(ValueError, match="limit must be an integer"):
        checked_count("3", "limit")
