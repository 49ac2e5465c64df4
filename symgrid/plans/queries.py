"""Queries over the driver's tables, one or more per operator, with their oracle SQL.

Most run on symbols registered in the session. Those named ``stored_*`` first write the
symbol into a store in the shared folder (once per application) and query that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.operators.catalog import preload, require_symbol, symbols
from symgrid.operators.domains import domain_values
from symgrid.operators.read import read_symbol
from symgrid.plans import oracle
from symgrid.plans.symbols import symbol_set, symbol_store
from symgrid.sources.shared import new_folder
from symgrid.sources.views import register_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its oracle SQL if there is one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def read(spark: SparkSession, sf_dir: str, symbol: str, **options) -> DataFrame:
    return read_symbol(spark, symbol_set(spark, sf_dir, symbol), symbol, **options)


def read_stored(spark: SparkSession, sf_dir: str, symbol: str, **options) -> DataFrame:
    return read_symbol(spark, symbol_store(spark, sf_dir, symbol), symbol, **options)


# -- scans -----------------------------------------------------------------------------


@query(f"SELECT SUM(value) AS total FROM ({oracle.SYMBOLS['pairs']}) r WHERE n_name_1 = 'NATION_7'")
def sum_of_filtered_parameter(spark, sf_dir):
    pairs = read(spark, sf_dir, "pairs", dimension_filters={"n_name_1": "NATION_7"})
    return pairs.agg(F.sum("value").alias("total"))


@query(oracle.scan("revenue"))
def scan_parameter(spark, sf_dir):
    return read(spark, sf_dir, "revenue")


@query(oracle.scan("order_stats"))
def scan_variable(spark, sf_dir):
    return read(spark, sf_dir, "order_stats")


@query(oracle.scan("balance"))
def scan_equation(spark, sf_dir):
    return read(spark, sf_dir, "balance")


@query(oracle.scan("nations"))
def scan_set(spark, sf_dir):
    return read(spark, sf_dir, "nations")


@query(oracle.scan("total"))
def scan_scalar(spark, sf_dir):
    return read(spark, sf_dir, "total")


@query(oracle.scan("trade"))
def scan_four_dims(spark, sf_dir):
    return read(spark, sf_dir, "trade")


@query(oracle.scan("pairs"))
def scan_repeated_label(spark, sf_dir):
    return read(spark, sf_dir, "pairs")


@query(oracle.scan("coded"))
def scan_unknown_type(spark, sf_dir):
    return read(spark, sf_dir, "coded")


_RANKED = "dim_1, dim_2, is_sparse_break, is_dense_run, value"


@query(f"SELECT {_RANKED} FROM ({oracle.scan('ranked_pairs')}) s")
def scan_in_label_order(spark, sf_dir):
    return read(spark, sf_dir, "ranked_pairs")


@query(f"SELECT {_RANKED} FROM ({oracle.scan('ranked_pairs')}) s")
def stored_scan_in_label_order(spark, sf_dir):
    return read_stored(spark, sf_dir, "ranked_pairs")


@query(oracle.scan("shipments"))
def stored_scan(spark, sf_dir):
    return read_symbol(spark, symbol_store(spark, sf_dir, "shipments"), "SHIPMENTS")


@query(oracle.scan("order_stats"))
def stored_scan_variable(spark, sf_dir):
    return read_stored(spark, sf_dir, "order_stats")


@query(oracle.scan("nations"))
def stored_scan_set(spark, sf_dir):
    return read_stored(spark, sf_dir, "nations")


@query(oracle.scan("total"))
def stored_scan_scalar(spark, sf_dir):
    return read_stored(spark, sf_dir, "total")


@query(oracle.scan("shipments"))
def stored_export(spark, sf_dir):
    """A symbol exported to plain Parquet and read back."""
    path = new_folder(spark, "export")
    read_stored(spark, sf_dir, "shipments").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# -- catalog ---------------------------------------------------------------------------

_CATALOG = oracle.catalog(
    {
        "nations": ("Set", "Nations and their regions", "*"),
        "revenue": ("Parameter", "Revenue by supplier nation and brand", "n_name,p_brand"),
        "order_stats": ("Variable", "Order totals", "c_mktsegment,o_orderpriority"),
        "balance": ("Equation", "Account balances", "n_name"),
        "total": ("Parameter", "Value of all orders", ""),
        "shipments": ("Parameter", "Quantity shipped by order and part", "l_returnflag,l_linestatus,*,*"),
    }
)
_CATALOG_SYMBOLS = ("nations", "revenue", "order_stats", "balance", "total", "shipments")


def _flat(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("domain_labels", F.array_join("domain_labels", ","))


@query(_CATALOG)
def symbol_catalog(spark, sf_dir):
    return _flat(symbols(spark, symbol_set(spark, sf_dir, *_CATALOG_SYMBOLS)))


@query(_CATALOG)
def stored_symbol_catalog(spark, sf_dir):
    store = symbol_store(spark, sf_dir, *_CATALOG_SYMBOLS)
    preload(spark, store, symbol="REVENUE", force_reload=True)
    return _flat(symbols(spark, store).where(F.col("symbol_name").isin(*_CATALOG_SYMBOLS)))


@query(
    "SELECT symbol_type, string_agg(symbol_name, ' < ' ORDER BY record_count, symbol_name) AS by_size, "
    f"CAST(SUM(record_count) AS BIGINT) AS records FROM ({_CATALOG}) c GROUP BY symbol_type"
)
def catalog_string_agg(spark, sf_dir):
    symbols(spark, symbol_set(spark, sf_dir, *_CATALOG_SYMBOLS)).createOrReplaceTempView("symgrid_catalog")
    return spark.sql(
        "SELECT symbol_type, listagg(symbol_name, ' < ') WITHIN GROUP (ORDER BY record_count, symbol_name) AS by_size, "
        "SUM(record_count) AS records FROM symgrid_catalog GROUP BY symbol_type"
    )


@query(
    f"{_CATALOG} UNION ALL SELECT 'countries', 'Alias', dimension_count, record_count, description, domain_labels "
    f"FROM ({_CATALOG}) c WHERE symbol_name = 'nations'"
)
def catalog_with_alias(spark, sf_dir):
    container = symbol_set(spark, sf_dir, *_CATALOG_SYMBOLS)
    container.register_alias("countries", "nations")
    return _flat(symbols(spark, container))


@query(oracle.scan("nations"))
def stored_scan_by_uri(spark, sf_dir):
    path = str(symbol_store(spark, sf_dir, "nations"))
    return read_symbol(spark, path if "://" in path or path.startswith("file:") else f"file://{path}", "nations")


@query(f"SELECT 'nations' AS symbol_name, COUNT(*) AS members FROM ({oracle.SYMBOLS['nations']}) r WHERE is_member")
def count_of_required_set(spark, sf_dir):
    container = symbol_set(spark, sf_dir, "nations")
    meta = require_symbol(spark, container, "Nations")
    members = read_symbol(spark, container, meta.name).where("is_member")
    return members.agg(F.count("*").alias("members")).withColumn("symbol_name", F.lit(meta.name))


# -- filters and projections -----------------------------------------------------------


@query(f"SELECT * FROM ({oracle.scan('revenue')}) s WHERE n_name = 'NATION_3'")
def filter_one_dim(spark, sf_dir):
    return read(spark, sf_dir, "revenue", dimension_filters={" N_NAME ": " NATION_3 "})


_FOUR = "dim_1 = 'NATION_1' AND dim_2 = 'NATION_2' AND dim_3 = 'Brand#5' AND dim_4 = 'A'"


@query(f"SELECT * FROM ({oracle.scan('trade')}) s WHERE {_FOUR}")
def filter_four_dims(spark, sf_dir):
    filters = {"dim_1": "NATION_1", "dim_2": "NATION_2", "dim_3": "Brand#5", "DIM_4": "A"}
    return read(spark, sf_dir, "trade", dimension_filters=filters)


@query(f"SELECT * FROM ({oracle.scan('trade')}) s WHERE {_FOUR}")
def where_four_dims(spark, sf_dir):
    return read(spark, sf_dir, "trade").where(_FOUR)


@query(f"SELECT * FROM ({oracle.scan('trade')}) s WHERE {_FOUR}")
def stored_filter_four_dims(spark, sf_dir):
    filters = {"dim_1": "NATION_1", "dim_2": "NATION_2", "dim_3": "Brand#5", "DIM_4": "A"}
    return read_stored(spark, sf_dir, "trade", dimension_filters=filters)


@query(f"SELECT * FROM ({oracle.scan('pairs')}) s WHERE n_name = 'NATION_4' AND n_name_1 = 'NATION_4'")
def filter_same_label_two_dims(spark, sf_dir):
    filters = {"n_name": "NATION_4", "n_name_1": "NATION_4"}
    return read(spark, sf_dir, "pairs", dimension_filters=filters)


@query(f"SELECT * FROM ({oracle.scan('nations')}) s WHERE dim_1 = 'NATION_9'")
def filter_by_symbol_name(spark, sf_dir):
    return read(spark, sf_dir, "nations", dimension_filters={"nations": "NATION_9"})


@query(f"SELECT * FROM ({oracle.scan('revenue')}) s WHERE lower(p_brand) = 'brand#12'")
def filter_ignore_case(spark, sf_dir):
    return read(spark, sf_dir, "revenue", dimension_filters={"p_brand": "BRAND#12"}, ignore_case=True)


@query(f"SELECT * FROM ({oracle.scan('shipments')}) s WHERE l_returnflag = 'R' AND l_linestatus = 'F'")
def stored_filter_ignore_case(spark, sf_dir):
    filters = {"l_returnflag": "r", "l_linestatus": "f"}
    return read_stored(spark, sf_dir, "shipments", dimension_filters=filters, ignore_case=True)


@query(f"SELECT * FROM ({oracle.scan('revenue')}) s WHERE n_name = 'no such label'")
def filter_unknown_label(spark, sf_dir):
    return read(spark, sf_dir, "revenue", dimension_filters={"n_name": "no such label"})


@query(f"SELECT * FROM ({oracle.scan('shipments')}) s WHERE dim_4 = '7'")
def stored_filter_last_dim(spark, sf_dir):
    """Read through the index of labels: only parts that hold the label are opened."""
    return read_stored(spark, sf_dir, "shipments", dimension_filters={"dim_4": "7"})


@query(f"SELECT * FROM ({oracle.scan('trade')}) s WHERE lower(dim_2) = 'nation_5' AND lower(dim_3) = 'brand#7'")
def stored_filter_later_dims_ignore_case(spark, sf_dir):
    filters = {"dim_3": "brand#7", "dim_2": "nation_5"}
    return read_stored(spark, sf_dir, "trade", dimension_filters=filters, ignore_case=True)


@query(
    'SELECT c_mktsegment, o_orderpriority, is_sparse_break, is_dense_run, "upper", level '
    f"FROM ({oracle.scan('order_stats')}) s"
)
def project_values(spark, sf_dir):
    return read(spark, sf_dir, "order_stats", value_columns=["upper", "level"])


@query(oracle.scan("ratio"))
def special_to_null(spark, sf_dir):
    return read(spark, sf_dir, "ratio")


@query(f"SELECT level AS value, marginal FROM ({oracle.SYMBOLS['order_stats']}) s "
       "WHERE c_mktsegment = 'BUILDING' AND o_orderpriority LIKE '2-%'")
def where_like_after_scan(spark, sf_dir):
    stats = read(spark, sf_dir, "order_stats")
    chosen = stats.where((F.col("c_mktsegment") == "BUILDING") & F.col("o_orderpriority").like("2-%"))
    return chosen.select(F.col("level").alias("value"), "marginal")


@query(f"SELECT * FROM ({oracle.scan('padded')}) s WHERE dim_1 = 'NATION_3'")
def filter_padded_label(spark, sf_dir):
    """White space around a label counts neither in the table nor in the filter."""
    return read(spark, sf_dir, "padded", dimension_filters={"dim_1": "NATION_3\t"})


# -- paging ----------------------------------------------------------------------------


@query(oracle.page("revenue", 0, 10))
def page_first(spark, sf_dir):
    return read(spark, sf_dir, "revenue", row_limit=10)


@query(oracle.page("trade", 10000, 2500))
def page_middle(spark, sf_dir):
    return read(spark, sf_dir, "trade", row_offset=10000, row_limit=2500)


@query(oracle.page("shipments", 41_000, 3000))
def page_deep_session(spark, sf_dir):
    return read(spark, sf_dir, "shipments", row_offset=41_000, row_limit=3000)


@query(oracle.page("trade", 100, 50, "dim_2 = 'NATION_5' AND dim_4 = 'N'"))
def page_filtered(spark, sf_dir):
    filters = {"dim_2": "NATION_5", "dim_4": "N"}
    return read(spark, sf_dir, "trade", dimension_filters=filters, row_offset=100, row_limit=50)


@query(f"SELECT {_RANKED} FROM ({oracle.page('ranked_pairs', 60, 40)}) s")
def page_in_label_order(spark, sf_dir):
    return read(spark, sf_dir, "ranked_pairs", row_offset=60, row_limit=40)


@query(f"SELECT {_RANKED} FROM ({oracle.page('ranked_pairs', 60, 40)}) s")
def stored_page_in_label_order(spark, sf_dir):
    return read_stored(spark, sf_dir, "ranked_pairs", row_offset=60, row_limit=40)


@query(oracle.page("shipments", 0, 10000))
def stored_page_first(spark, sf_dir):
    return read_stored(spark, sf_dir, "shipments", row_limit=10000)


@query(oracle.page("shipments", 40000, 10000))
def stored_page_deep(spark, sf_dir):
    return read_stored(spark, sf_dir, "shipments", row_offset=40000, row_limit=10000)


@query(oracle.page("shipments", 20000, 5000, "l_linestatus = 'O'"))
def stored_page_filtered(spark, sf_dir):
    filters = {"l_linestatus": "O"}
    return read_stored(spark, sf_dir, "shipments", dimension_filters=filters, row_offset=20000, row_limit=5000)


@query(oracle.page("shipments", 25000, 1 << 40))
def stored_rest_after_offset(spark, sf_dir):
    return read_stored(spark, sf_dir, "shipments", row_offset=25000)


# -- markers ---------------------------------------------------------------------------


@query(f"SELECT n_name, n_name_1, is_sparse_break, is_dense_run FROM ({oracle.scan('pairs')}) s")
def markers(spark, sf_dir):
    return read(spark, sf_dir, "pairs").drop("value")


def _marker_counts(symbol: DataFrame, dimension: str) -> DataFrame:
    """Breaks and run-on records per label of a dimension."""
    return symbol.groupBy(dimension).agg(
        F.count_if("is_sparse_break").alias("breaks"), F.count_if("is_dense_run").alias("dense")
    )


def _marker_counts_sql(symbol: str, dimension: str) -> str:
    return (
        f"SELECT {dimension}, COUNT(*) FILTER (is_sparse_break) AS breaks, COUNT(*) FILTER (is_dense_run) AS dense "
        f"FROM ({oracle.scan(symbol)}) s GROUP BY {dimension}"
    )


@query(_marker_counts_sql("trade", "dim_4"))
def marker_counts(spark, sf_dir):
    return _marker_counts(read(spark, sf_dir, "trade"), "dim_4")


@query(_marker_counts_sql("shipments", "l_linestatus"))
def stored_marker_counts(spark, sf_dir):
    return _marker_counts(read_stored(spark, sf_dir, "shipments"), "l_linestatus")


@query(
    f"SELECT l_returnflag, dim_3, dim_4 FROM ({oracle.scan('shipments')}) s "
    "WHERE l_linestatus = 'F' AND is_sparse_break"
)
def markers_of_filtered_scan(spark, sf_dir):
    """Markers describe the whole symbol, also when only a part of it is read."""
    part = read(spark, sf_dir, "shipments", dimension_filters={"l_linestatus": "F"})
    return part.where("is_sparse_break").select("l_returnflag", "dim_3", "dim_4")


# -- domain values ---------------------------------------------------------------------


def _domain(symbol: str, dimension: str, where: str = "TRUE") -> str:
    return f"SELECT DISTINCT {dimension} AS value FROM ({oracle.SYMBOLS[symbol]}) r WHERE {where} ORDER BY value"


@query(_domain("trade", "dim_3"))
def domain_values_of_dimension(spark, sf_dir):
    return domain_values(spark, symbol_set(spark, sf_dir, "trade"), "trade", 3)


@query(_domain("trade", "dim_3", "dim_1 = 'NATION_2' AND dim_2 = 'NATION_6' AND dim_4 = 'R'"))
def domain_values_cascade(spark, sf_dir):
    filters = {"dim_1": "NATION_2", "dim_2": "NATION_6", "dim_4": "R"}
    return domain_values(spark, symbol_set(spark, sf_dir, "trade"), "trade", "dim_3", filters)


@query(_domain("pairs", "n_name_1", "n_name_1 = 'NATION_8'"))
def domain_values_self_filtered(spark, sf_dir):
    return domain_values(spark, symbol_set(spark, sf_dir, "pairs"), "pairs", 2, {"n_name_1": "NATION_8"})


@query(_domain("shipments", "dim_3"))
def stored_domain_values(spark, sf_dir):
    return domain_values(spark, symbol_store(spark, sf_dir, "shipments"), "shipments", 3)


@query(_domain("shipments", "dim_4", "l_returnflag = 'N' AND l_linestatus = 'O'"))
def stored_domain_values_cascade(spark, sf_dir):
    filters = {"l_returnflag": "N", "l_linestatus": "O"}
    return domain_values(spark, symbol_store(spark, sf_dir, "shipments"), "shipments", "dim_4", filters)


@query(
    "SELECT CAST(1 AS INTEGER) AS dim_index, COUNT(DISTINCT l_returnflag) AS labels FROM lineitem UNION ALL "
    "SELECT CAST(2 AS INTEGER), COUNT(DISTINCT l_linestatus) FROM lineitem UNION ALL "
    "SELECT CAST(3 AS INTEGER), COUNT(DISTINCT l_orderkey) FROM lineitem UNION ALL "
    "SELECT CAST(4 AS INTEGER), COUNT(DISTINCT l_partkey) FROM lineitem"
)
def stored_domain_sizes(spark, sf_dir):
    """The distinct labels of all dimensions, found in one pass when the symbol was written."""
    store = symbol_store(spark, sf_dir, "shipments")
    return store.all_labels(store.find("shipments")).groupBy("dim_index").agg(F.count("*").alias("labels"))


# -- SQL -------------------------------------------------------------------------------


@query(
    f"SELECT dim_4, SUM(value) AS total FROM ({oracle.SYMBOLS['trade']}) r "
    "WHERE dim_1 = 'NATION_1' AND dim_3 IN ('Brand#1', 'Brand#2') GROUP BY dim_4"
)
def sql_over_views(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "trade"), "stored_")
    return spark.sql(
        "SELECT dim_4, SUM(value) AS total FROM stored_trade "
        "WHERE dim_1 = :nation AND dim_3 IN ('Brand#1', 'Brand#2') GROUP BY dim_4",
        args={"nation": "NATION_1"},
    )


@query(f"SELECT CAST(SUM(value) AS INTEGER) AS total FROM ({oracle.SYMBOLS['shipments']}) r")
def sql_sum_as_integer(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "shipments"), "stored_")
    return spark.sql("SELECT CAST(SUM(value) AS INT) AS total FROM stored_shipments")


@query(
    f"SELECT * FROM ({oracle.scan('shipments')}) s "
    "ORDER BY value DESC, l_returnflag, l_linestatus, dim_3, dim_4 LIMIT 100 OFFSET 50"
)
def sql_order_limit_offset(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "shipments"), "stored_")
    return spark.sql(
        "SELECT * FROM stored_shipments "
        "ORDER BY value DESC, l_returnflag, l_linestatus, dim_3, dim_4 LIMIT 100 OFFSET 50"
    )


@query(f"SELECT dim_2, dim_4, value FROM ({oracle.SYMBOLS['trade']}) r WHERE dim_1 = 'NATION_1' AND dim_3 = 'Brand#2'")
def sql_table_function(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "trade"), "stored_")
    return spark.sql(
        "SELECT dim_2, dim_4, value "
        "FROM read_stored_trade(dimension_filters => map('dim_1', 'NATION_1', 'DIM_3', 'Brand#2'))"
    )


@query(_domain("trade", "dim_3", "dim_1 = 'NATION_2' AND dim_2 = 'NATION_6' AND dim_4 = 'R'"))
def sql_domain_values(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "trade"), "stored_")
    return spark.sql(
        "SELECT value FROM domain_values_stored_trade("
        "3, dimension_filters => map('dim_1', 'NATION_2', 'dim_2', 'NATION_6', 'dim_4', 'R'))"
    )


@query(
    f"SELECT n_name_1, value FROM ({oracle.SYMBOLS['pairs']}) r WHERE n_name = 'NATION_4' AND n_name_1 IN ('NATION_2', 'NATION_3')"
)
def sql_filter_by_label_and_alias(spark, sf_dir):
    """Both dimensions have one label; the second answers to its column name."""
    register_views(spark, symbol_store(spark, sf_dir, "pairs"), "stored_")
    return spark.sql(
        "SELECT n_name_1, value FROM read_stored_pairs(dimension_filters => map('\\tN_Name ', ' NATION_4', 'n_name_1', 'NATION_2')) "
        "UNION ALL SELECT n_name_1, value FROM read_stored_pairs(map('n_name', 'NATION_4', ' N_NAME_1', 'NATION_3\\n'))"
    )


@query(oracle.page("shipments", 30_000, 10_000))
def sql_page(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "shipments"), "stored_")
    return spark.sql("SELECT * FROM page_stored_shipments(row_offset => 30000, row_limit => 10000)")


@query(oracle.page("shipments", 20_000, 5_000, "l_linestatus = 'O'"))
def sql_filtered_page(spark, sf_dir):
    """All of a scan's arguments in one call."""
    register_views(spark, symbol_store(spark, sf_dir, "shipments"), "stored_")
    return spark.sql(
        "SELECT * FROM read_stored_shipments("
        "dimension_filters => map('l_linestatus', 'O'), value_columns => array('value'), row_offset => 20000, row_limit => 5000)"
    )


@query(
    'SELECT c_mktsegment, o_orderpriority, is_sparse_break, is_dense_run, CAST(NULL AS DOUBLE) AS level, marginal, '
    'CAST(NULL AS DOUBLE) AS "lower", "upper", CAST(NULL AS DOUBLE) AS scale '
    f"FROM ({oracle.scan('order_stats')}) s"
)
def sql_value_columns(spark, sf_dir):
    """Value columns that are not asked for are NULL, and not read."""
    register_views(spark, symbol_store(spark, sf_dir, "order_stats"), "stored_")
    return spark.sql("SELECT * FROM read_stored_order_stats(value_columns => array('upper', 'marginal'))")


@query(oracle.scan("trade"))
def sql_null_arguments(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "trade"), "stored_")
    return spark.sql(
        "SELECT * FROM read_stored_trade("
        "dimension_filters => NULL, value_columns => NULL, row_offset => NULL, row_limit => NULL, ignore_case => NULL)"
    )


@query(f"SELECT * FROM ({oracle.scan('shipments')}) s WHERE l_returnflag = 'R' AND l_linestatus = 'F'")
def sql_filter_ignore_case(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "shipments"), "stored_")
    return spark.sql("SELECT * FROM read_stored_shipments(map('l_returnflag', 'r', 'L_LINESTATUS', 'f'), ignore_case => true)")


@query(_domain("trade", "dim_3", "dim_1 = 'NATION_2' AND dim_4 = 'R'"))
def sql_domain_values_by_name(spark, sf_dir):
    register_views(spark, symbol_store(spark, sf_dir, "trade"), "stored_")
    return spark.sql("SELECT value FROM domain_values_stored_trade('DIM_3', map('dim_1', 'NATION_2', 'dim_4', 'R'))")


@query(f"SELECT 'shipments' AS symbol_name, COUNT(*) AS records FROM ({oracle.SYMBOLS['shipments']}) r")
def sql_preload(spark, sf_dir):
    """The symbol is required before it is counted."""
    register_views(spark, symbol_store(spark, sf_dir, "shipments"), "stored_")
    return spark.sql(
        "SELECT 'shipments' AS symbol_name, (SELECT record_count FROM stored_symbols WHERE symbol_name = 'shipments') AS records "
        "FROM preload_stored_symbols(symbol => 'Shipments') WHERE success"
    )


@query(f"SELECT p_brand, SUM(value) AS total FROM ({oracle.SYMBOLS['revenue']}) r WHERE n_name = 'NATION_3' GROUP BY p_brand")
def sql_session_filter(spark, sf_dir):
    """Symbols of a session answer to the same SQL."""
    register_views(spark, symbol_set(spark, sf_dir, "revenue"), "live_")
    return spark.sql("SELECT p_brand, SUM(value) AS total FROM read_live_revenue(map('n_name', 'NATION_3')) GROUP BY p_brand")


@query(oracle.page("shipments", 55_000, 500))
def page_session_copy(spark, sf_dir):
    """A deep page of a session symbol, found by order statistics."""
    container = symbol_set(spark, sf_dir, "shipments")
    container.TOP = 1000
    return read_symbol(spark, container, "shipments", row_offset=55_000, row_limit=500)
