"""Column names and types by symbol type and labels."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from symgrid.functions.naming import symbol_columns, type_name, unique_names, value_columns


def test_blank_undeclared_and_repeated_labels():
    assert symbol_columns(["", "region", "*", "region"], ["value"]) == [
        "dim_1", "region", "dim_3", "region_1", "is_sparse_break", "is_dense_run", "value",
    ]


def test_repeated_value_names_without_markers():
    assert symbol_columns(["i"], ["custom", "custom"]) == ["i", "custom", "custom_1"]


def test_clashes_across_dimensions_markers_and_values():
    assert symbol_columns(["value", "is_dense_run"], ["value"]) == [
        "value", "is_dense_run", "is_sparse_break", "is_dense_run_1", "value_1",
    ]


def test_suffixes_skip_taken_names_and_fold_case():
    assert unique_names(["a", "a_1", "A", "a"]) == ["a", "a_1", "A_2", "a_3"]


def test_scalar_has_only_values():
    assert symbol_columns([], ["value"]) == ["value"]


@pytest.mark.parametrize(
    ("code", "name"),
    [(0, "Set"), (1, "Parameter"), (2, "Variable"), (3, "Equation"), (4, "Alias"), (5, "Unknown"), (-1, "Unknown"),
     ("set", "Set"), (" Variable ", "Variable"), ("unknown", "Unknown")],
)
def test_type_names(code, name):
    assert type_name(code) == name


def test_value_columns_by_type():
    assert value_columns("Set") == ("is_member", "description")
    assert value_columns("Parameter") == ("value",)
    assert value_columns("Variable") == ("level", "marginal", "lower", "upper", "scale")
    assert value_columns("Equation") == value_columns("Variable")
    assert value_columns(77) == ("value",)


@given(st.lists(st.sampled_from(["a", "A", "a_1", "A_1", "b", "a_1_1", "value"]), max_size=12))
def test_names_are_unique_ignoring_case_and_first_ones_unchanged(names):
    result = unique_names(names)
    assert len({name.lower() for name in result}) == len(names)
    for position, (before, after) in enumerate(zip(names, result)):
        assert after == before or after.startswith(f"{before}_")
        if before.lower() not in {name.lower() for name in result[:position]}:
            assert after == before
