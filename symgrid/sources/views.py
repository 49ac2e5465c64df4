"""Symbols for SQL: temporary views, and table functions with named arguments.

The arguments of a call are literals, and the bodies are written of functions that fold away for literals (one with a lambda would not).
So a call ends up as the plan that the Python call has: plain comparisons pushed to the scan, a page as a range of stored places,
unused columns pruned, and none of the checks left. Since a map's entries cannot be walked without a lambda, they are taken by
place; a call with more entries than names has a repeated or an unknown one among the first.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from symgrid.functions.naming import VALUE_COLUMNS, symbol_columns
from symgrid.model import SymbolMeta
from symgrid.operators.arguments import (
    BLANK_KEY,
    BLANK_VALUE,
    DUPLICATE_FILTER,
    DUPLICATE_VALUE,
    NO_DIMENSION,
    NO_SYMBOL_NAME,
    NULL_FILTER,
    NULL_VALUE_COLUMN,
    OUT_OF_RANGE,
    UNKNOWN_DIMENSION,
    UNKNOWN_VALUE,
    dimension_aliases,
)
from symgrid.operators.catalog import symbols
from symgrid.operators.read import output_columns, read_symbol
from symgrid.sources.containers import Container, open_container
from symgrid.sources.store import SymbolStore

#: Of symbols of more parts than this, a page's parts are found by a join rather than from numbers in the function.
PARTS_IN_TEXT = 500
_NO_LIMIT = str(1 << 62)
_NOT_GIVEN = "\\u0000"


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The characters of WHITE as SQL text.
_WHITE_SQL = "' \\t\\n\\u000b\\u000c\\r'"


def _raise(message: str, *values: str) -> str:
    """raise_error with the message, whose places ``{}`` are SQL expressions."""
    parts = message.split("{}")
    texts = [piece for k, part in enumerate(parts) for piece in (_text(part), *values[k : k + 1])]
    return f"raise_error(concat({', '.join(texts)}))"


def _checks(tests: list[tuple[str, str]]) -> list[str]:
    """Conditions that hold, or raise where the first of a pair does."""
    return [f"if({condition}, {raised}, true)" for condition, raised in tests]


_FILTERS = "coalesce(dimension_filters, CAST(map() AS MAP<STRING, STRING>))"


class _Filters:
    """SQL for the parameters ``dimension_filters MAP<STRING, STRING>`` and ``ignore_case BOOLEAN``; NULL means none."""

    def __init__(self, meta: SymbolMeta):
        self.aliases = dimension_aliases(meta)
        self.names = meta.dimension_names
        entries = range(meta.dimension_count + 1)
        self.keys = [f"lower(btrim(get(map_keys({_FILTERS}), {i}), {_WHITE_SQL}))" for i in entries]
        self.values = [f"get(map_values({_FILTERS}), {i})" for i in entries]

    def checks(self) -> list[str]:
        """Those of :mod:`symgrid.operators.arguments`, in their order."""
        pairs = list(zip(self.keys, self.values, strict=True))
        known = ", ".join(map(_text, self.aliases))
        raw = [f"btrim(get(map_keys({_FILTERS}), {i}), {_WHITE_SQL})" for i in range(len(pairs))]
        unknown = UNKNOWN_DIMENSION.format("{}", ", ".join(self.names))
        tests = [(f"{key} IS NOT NULL AND {value} IS NULL", _raise(NULL_FILTER)) for key, value in pairs]
        tests += [(f"{key} = ''", _raise(BLANK_KEY)) for key in self.keys]
        tests += [(f"btrim({value}, {_WHITE_SQL}) = ''", _raise(BLANK_VALUE)) for value in self.values]
        tests += [(f"{key} NOT IN ({known})", _raise(unknown, name)) for key, name in zip(self.keys, raw, strict=True)]
        for position, name in enumerate(self.names):
            times = " + ".join(f"if({self._is(key, position)}, 1, 0)" for key in self.keys)
            tests.append((f"{times} > 1", _raise(DUPLICATE_FILTER.format(name))))
        return _checks(tests)

    def _is(self, key: str, position: int) -> str:
        return f"{key} IN ({', '.join(_text(alias) for alias, at in self.aliases.items() if at == position)})"

    def tests(self, columns: list[str]) -> list[str]:
        """The comparisons, one for each dimension."""
        found = []
        for position, column in enumerate(columns):
            cases = " ".join(
                f"WHEN {self._is(key, position)} THEN btrim({value}, {_WHITE_SQL})" for key, value in zip(self.keys, self.values, strict=True)
            )
            label = f"CASE {cases} END"
            same = f"if(coalesce(ignore_case, false), lower({column}) = lower({label}), {column} = {label})"
            found.append(f"({label} IS NULL OR {same})")
        return found


def _returned(meta: SymbolMeta) -> tuple[list[str], str]:
    """Output columns of a symbol, and their declaration."""
    values = VALUE_COLUMNS[meta.symbol_type]
    names = symbol_columns(meta.domain_labels, [name for name, _ in values])
    kinds = ["string"] * meta.dimension_count
    kinds += ["boolean"] * (len(names) - meta.dimension_count - len(values))
    kinds += [kind for _, kind in values]
    return names, ", ".join(f"{_name(name)} {kind}" for name, kind in zip(names, kinds, strict=True))


def _value_checks(meta: SymbolMeta) -> list[str]:
    """Conditions on the parameter ``value_columns ARRAY<STRING>``; NULL and an empty one mean all."""
    known = ", ".join(map(_text, meta.values))
    entries = [f"get(value_columns, {i})" for i in range(len(meta.values) + 1)]
    tests = [(f"size(value_columns) > {i} AND {entry} IS NULL", _raise(NULL_VALUE_COLUMN)) for i, entry in enumerate(entries)]
    for i, entry in enumerate(entries):
        tests.append((f"{entry} NOT IN ({known})", _raise(UNKNOWN_VALUE.format("{}", meta.name), entry)))
        if i:
            tests.append((f"{entry} IN ({', '.join(entries[:i])})", _raise(DUPLICATE_VALUE, entry)))
    return _checks(tests)


def _selected(meta: SymbolMeta, names: list[str]) -> str:
    """The columns of a call. The value columns that it does not ask for are NULL, and not read."""
    count = len(names) - len(meta.values)
    chosen = "(value_columns IS NULL OR size(value_columns) = 0 OR array_contains(value_columns, {}))"
    values = [
        f"if({chosen.format(_text(value))}, {_name(name)}, NULL) AS {_name(name)}"
        for name, value in zip(names[count:], meta.values, strict=True)
    ]
    return ", ".join([*map(_name, names[:count]), *values])


_FROM, _TO = "coalesce(row_offset, 0L)", f"coalesce(row_offset, 0L) + coalesce(row_limit, {_NO_LIMIT}L)"
_PAGED = f"({_FROM} > 0 OR row_limit IS NOT NULL)"
_PAGE_CHECKS = _checks(
    [(f"{name} < 0", _raise(f"{what} must be non-negative")) for name, what in (("row_offset", "offset"), ("row_limit", "limit"))]
)


def _place(parts: list[dict], row: str) -> tuple[str, str]:
    """Part of a row number, and its place in it, as cases over where the parts start."""
    if not parts:
        return "0", "0L"
    after = list(zip(parts, [p["first_row"] for p in parts[1:]], strict=False))
    part = " ".join(f"WHEN {row} < {first}L THEN {p['part']}" for p, first in after)
    base = " ".join(f"WHEN {row} < {first}L THEN {p['first_row']}L" for p, first in after)
    last = parts[-1]
    return (f"CASE {part} ELSE {last['part']} END", f"{row} - CASE {base} ELSE {last['first_row']}L END") if after else (
        str(last["part"]), f"{row} - {last['first_row']}L"
    )


def _plain_page(records: str, parts_view: str, parts: list[dict]) -> str:
    """FROM and WHERE of the records of a page without filters; the page is a range of (part, place)."""
    if len(parts) > PARTS_IN_TEXT:
        number = "p.first_row + r.stored_pos"
        return (
            f"{_name(records)} r JOIN {_name(parts_view)} p ON r.stored_part = p.part WHERE {number} >= {_FROM} AND {number} < {_TO} "
            f"AND p.first_row + p.rows > {_FROM} AND p.first_row < {_TO}"
        )
    (start, low), (stop, high) = _place(parts, _FROM), _place(parts, f"({_TO} - 1)")
    return (
        f"{_name(records)} WHERE coalesce(row_limit, 1) > 0 AND stored_part >= {start} AND stored_part <= {stop} "
        f"AND (stored_part > {start} OR stored_pos >= {low}) AND (stored_part < {stop} OR stored_pos <= {high}) "
        f"AND stored_pos >= if({start} = {stop}, {low}, 0L) AND stored_pos <= if({start} = {stop}, {high}, {_NO_LIMIT}L)"
    )


def _filtered_page(records: str, block_rows: int, tests: str, hint: str) -> str:
    """A relation of the records of a filtered page; as in ``SymbolStore._filtered_page``."""
    block = f"stored_pos div {block_rows}"
    return (
        f"(WITH hits AS (SELECT *, {block} AS stored_block FROM {_name(records)} WHERE {tests}), "
        "sizes AS (SELECT stored_part AS part, stored_block AS block, count(*) AS rows FROM hits GROUP BY stored_part, stored_block), "
        "firsts AS (SELECT *, coalesce(sum(rows) OVER (ORDER BY part, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS first "
        "FROM sizes), "
        f"touched AS (SELECT part, block, first FROM firsts WHERE first < {_TO} AND first + rows > {_FROM}) "
        f"SELECT {hint} hits.*, first + row_number() OVER (PARTITION BY stored_part, stored_block ORDER BY stored_pos) - 1 AS stored_number "
        "FROM hits JOIN touched ON stored_part = part AND stored_block = block) "
        f"WHERE stored_number >= {_FROM} AND stored_number < {_TO}"
    )


_PARAMETERS = (
    "dimension_filters MAP<STRING, STRING> DEFAULT map(), value_columns ARRAY<STRING> DEFAULT array(), "
    "row_offset BIGINT DEFAULT 0, row_limit BIGINT DEFAULT NULL, ignore_case BOOLEAN DEFAULT false"
)


def _read_function(function: str, view: str, meta: SymbolMeta, parts: list[dict] | None, block_rows: int) -> str:
    """DDL of ``function(dimension_filters, value_columns, row_offset, row_limit, ignore_case)`` over a symbol.

    Its branches are the whole scan, a page, and a page of filtered records, short or long; those a call does not take fold away.
    """
    names, declared = _returned(meta)
    filters = _Filters(meta)
    selected = _selected(meta, names)
    checks = " AND ".join([*filters.checks(), *_value_checks(meta), *_PAGE_CHECKS])
    tests = " AND ".join(filters.tests([_name(name) for name in names[: meta.dimension_count]]))
    head = f"CREATE OR REPLACE TEMPORARY FUNCTION {_name(function)}({_PARAMETERS}) RETURNS TABLE ({declared}) RETURN "
    if parts is None:
        unpaged = f"if({_PAGED}, {_raise('row_offset and row_limit need a stored symbol')}, true)"
        return head + f"SELECT {selected} FROM {_name(view)} WHERE {checks} AND {unpaged} AND {tests}"
    records, order = f"records_{view}", "ORDER BY stored_part, stored_pos"
    columns = ", ".join(map(_name, names))
    none, some = f"size({_FILTERS}) = 0", f"size({_FILTERS}) > 0"
    whole = f"SELECT {selected} FROM {_name(records)} WHERE {checks} AND NOT {_PAGED} AND {tests}"
    page = f"SELECT {selected} FROM {_plain_page(records, f'parts_{view}', parts)} AND {checks} AND {_PAGED} AND {none} {order}"
    branches = [f"SELECT {columns} FROM ({whole})", f"SELECT {columns} FROM ({page})"]
    for compare, hint in (("<=", "/*+ BROADCAST(touched) */"), (">", "")):
        size = f"coalesce(row_limit, {_NO_LIMIT}L) {compare} {SymbolStore.BROADCAST_LIMIT}"
        hits = _filtered_page(records, block_rows, f"{checks} AND {_PAGED} AND {some} AND {size} AND {tests}", hint)
        branches.append(f"SELECT {columns} FROM (SELECT {selected} FROM {hits} {order})")
    return head + " UNION ALL ".join(branches)


def _page_function(function: str, view: str, meta: SymbolMeta, parts: list[dict]) -> str:
    """DDL of ``function(row_offset => n, row_limit => m)``: a page in stored order."""
    names, declared = _returned(meta)
    columns = ", ".join(map(_name, names))
    return (
        f"CREATE OR REPLACE TEMPORARY FUNCTION {_name(function)}(row_offset BIGINT DEFAULT 0, row_limit BIGINT DEFAULT NULL) "
        f"RETURNS TABLE ({declared}) RETURN SELECT {columns} FROM {_plain_page(f'records_{view}', f'parts_{view}', parts)} "
        f"AND {' AND '.join(_PAGE_CHECKS)} ORDER BY stored_part, stored_pos"
    )


def _domain_function(function: str, view: str, meta: SymbolMeta) -> str:
    """DDL of ``function(dimension, dimension_filters => map(...), ignore_case => false)``.

    ``dimension`` is a name or a 1-based number. Without filters it reads the labels view, with filters the symbol's; the branch
    not taken folds away, as does the choice of the column.
    """
    names, count = meta.dimension_names, meta.dimension_count
    aliases = dimension_aliases(meta)
    folded = f"lower(btrim(dimension, {_WHITE_SQL}))"
    named = " ".join(f"WHEN {folded} = {_text(alias)} THEN {position + 1}" for alias, position in aliases.items())
    numbered = " ".join(f"WHEN {folded} = '{position}' THEN {position}" for position in range(1, count + 1))
    out_of_range = _raise(OUT_OF_RANGE.format("{}", meta.name, count), folded)
    unknown = _raise(NO_DIMENSION.format("{}", meta.name, ", ".join(names)), "coalesce(dimension, 'NULL')")
    place = f"CASE {named} {numbered} WHEN {folded} RLIKE '^[+-]?[0-9]+$' THEN {out_of_range} ELSE {unknown} END"
    column = " ".join(f"WHEN {i} THEN {_name(name)}" for i, name in enumerate(names, start=1))
    filters = _Filters(meta)
    tests = " AND ".join([*filters.checks(), *filters.tests([_name(name) for name in names])])
    return (
        f"CREATE OR REPLACE TEMPORARY FUNCTION {_name(function)}(dimension STRING, "
        "dimension_filters MAP<STRING, STRING> DEFAULT map(), ignore_case BOOLEAN DEFAULT false) RETURNS TABLE (value STRING) "
        f"RETURN SELECT value FROM (SELECT value FROM {_name(f'labels_{view}')} WHERE size({_FILTERS}) = 0 AND dim_index = {place} "
        f"UNION ALL SELECT DISTINCT CASE {place} {column} END AS value FROM {_name(view)} "
        f"WHERE size({_FILTERS}) > 0 AND {tests}) ORDER BY value"
    )


def _preload_function(function: str, container: Container) -> str:
    """DDL of ``function(symbol => 'x')``: one row, or the error of :func:`symgrid.preload` if there is no such symbol."""
    known = ", ".join([_text(meta.name.lower()) for meta in container.metas()] or ["NULL"])
    missing = _raise(f"Symbol '{{}}' not found in '{container}'", "symbol")
    return (
        f"CREATE OR REPLACE TEMPORARY FUNCTION {_name(function)}(symbol STRING DEFAULT '{_NOT_GIVEN}') RETURNS TABLE (success BOOLEAN) "
        f"RETURN SELECT true AS success WHERE if(symbol IS NULL, {_raise(NO_SYMBOL_NAME)}, true) "
        f"AND if(symbol = '{_NOT_GIVEN}' OR coalesce(lower(symbol) IN ({known}), false), true, {missing})"
    )


def _register(spark: SparkSession, container: Container, meta: SymbolMeta, prefix: str, functions: bool) -> str:
    view = f"{prefix}{meta.name}"
    read_symbol(spark, container, meta.name).createOrReplaceTempView(_name(view))
    if functions and meta.dimension_count:
        container.all_labels(meta).createOrReplaceTempView(_name(f"labels_{view}"))
        parts, block_rows = None, 0
        if isinstance(container, SymbolStore):
            records = container.records(meta).withColumnsRenamed({"part": "stored_part", "pos": "stored_pos"})
            columns = [*output_columns(meta, meta.values), "stored_part", "stored_pos"]
            records.select(*columns).createOrReplaceTempView(_name(f"records_{view}"))
            container.parts(meta).createOrReplaceTempView(_name(f"parts_{view}"))
            parts, block_rows = container.part_list(meta), container.block_rows(meta)
            spark.sql(_page_function(f"page_{view}", view, meta, parts))
        spark.sql(_read_function(f"read_{view}", view, meta, parts, block_rows))
        spark.sql(_domain_function(f"domain_values_{view}", view, meta))
    return view


def register_views(
    spark: SparkSession, source: str | Container, prefix: str = "", functions: bool = True
) -> list[str]:
    """Create a temporary view ``<prefix><symbol>`` for each symbol, and ``<prefix>symbols``.

    With ``functions`` each symbol with dimensions also gets table functions with the arguments, rules and messages of the Python calls:
    ``read_<prefix><symbol>(dimension_filters => map('i', 'seattle'), value_columns => array('level'), row_offset => 10,
    row_limit => 10, ignore_case => false)``, where value columns not asked for are NULL, and
    ``domain_values_<prefix><symbol>('j', dimension_filters => map('i', 'seattle'))``, by name or number; a stored one also
    ``page_<prefix><symbol>(row_offset => 10000, row_limit => 10000)``. Arguments that are NULL count as not given. These read the views
    ``records_<prefix><symbol>``, which has the stored order in ``stored_part`` and ``stored_pos``, ``parts_<prefix><symbol>`` and
    ``labels_<prefix><symbol>``. ``preload_<prefix>symbols(symbol => 'x')`` fails if there is no such symbol. Aliases have no view.
    Returns the names of the symbols' views. Column pruning and WHERE conditions reach the Parquet
    scan through views and functions alike. Session symbols take no page arguments in SQL.

    Views of a store follow the symbols that this application writes to it. Writes of other applications show after
    ``preload(..., force_reload=True)`` and another call of this function.
    """
    container = open_container(spark, source)

    def catalog() -> None:
        symbols(spark, container).createOrReplaceTempView(_name(f"{prefix}symbols"))
        if functions:
            spark.sql(_preload_function(f"preload_{prefix}symbols", container))

    def written(meta: SymbolMeta) -> None:
        catalog()
        if meta.symbol_type != "Alias":
            _register(spark, container, meta, prefix, functions)

    catalog()
    if isinstance(container, SymbolStore):
        container.watch((prefix, functions), written)
    scanned = [meta for meta in container.metas() if meta.symbol_type != "Alias"]
    return [f"{prefix}symbols", *(_register(spark, container, meta, prefix, functions) for meta in scanned)]
