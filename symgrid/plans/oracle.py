"""SQL text of the symbols, for checking the queries against another engine on the same tables."""

from __future__ import annotations

_MONEY = "CAST({} AS DECIMAL(12,2))"


def _statistics(column: str) -> str:
    cents = _MONEY.format(column)
    return (
        f"CAST(SUM({cents}) AS DOUBLE) AS level, CAST(SUM({cents}) AS DOUBLE) / COUNT(*) AS marginal, "
        f'MIN({column}) AS "lower", MAX({column}) AS "upper", CAST(1 AS DOUBLE) AS scale'
    )


_TRADED = (
    "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN nation f ON s_nationkey = f.n_nationkey "
    "JOIN nation t ON c_nationkey = t.n_nationkey"
)

# Each symbol as a query with its output dimension and value columns, without markers.
SYMBOLS = {
    "nations": (
        "SELECT n_name AS dim_1, TRUE AS is_member, r_name AS description "
        "FROM nation JOIN region ON n_regionkey = r_regionkey"
    ),
    "revenue": (
        "SELECT n_name, p_brand, CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) "
        "* (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS value "
        "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey "
        "JOIN part ON l_partkey = p_partkey GROUP BY n_name, p_brand"
    ),
    "trade": (
        "SELECT f.n_name AS dim_1, t.n_name AS dim_2, p_brand AS dim_3, l_returnflag AS dim_4, "
        f"SUM(l_quantity) AS value FROM {_TRADED} JOIN part ON l_partkey = p_partkey "
        "GROUP BY f.n_name, t.n_name, p_brand, l_returnflag"
    ),
    "pairs": (
        "SELECT f.n_name AS n_name, t.n_name AS n_name_1, SUM(l_quantity) AS value "
        f"FROM {_TRADED} GROUP BY f.n_name, t.n_name"
    ),
    "ranked_pairs": (
        "SELECT f.n_name AS dim_1, t.n_name AS dim_2, SUM(l_quantity) AS value, "
        "f.n_nationkey AS rank_1, t.n_nationkey AS rank_2 "
        f"FROM {_TRADED} GROUP BY f.n_name, f.n_nationkey, t.n_name, t.n_nationkey"
    ),
    "coded": "SELECT p_type, CAST(COUNT(*) AS DOUBLE) AS value FROM part GROUP BY p_type",
    "order_stats": (
        f"SELECT c_mktsegment, o_orderpriority, {_statistics('o_totalprice')} "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderpriority"
    ),
    "balance": (
        f"SELECT n_name, {_statistics('c_acctbal')} "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
    ),
    "total": f"SELECT CAST(SUM({_MONEY.format('o_totalprice')}) AS DOUBLE) AS value FROM orders",
    "ratio": (
        "SELECT event_type, CASE WHEN event_type IN ('click', 'error') THEN NULL "
        f"ELSE CAST(SUM({_MONEY.format('value')}) AS DOUBLE) END AS value FROM events GROUP BY event_type"
    ),
    "padded": (
        f"SELECT n_name AS dim_1, c_mktsegment AS dim_2, CAST(SUM({_MONEY.format('c_acctbal')}) AS DOUBLE) AS value "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment"
    ),
    "shipments": (
        "SELECT l_returnflag, l_linestatus, CAST(l_orderkey AS VARCHAR) AS dim_3, "
        "CAST(l_partkey AS VARCHAR) AS dim_4, SUM(l_quantity) AS value "
        "FROM lineitem GROUP BY l_returnflag, l_linestatus, l_orderkey, l_partkey"
    ),
}

DIMENSIONS = {
    "nations": ["dim_1"],
    "revenue": ["n_name", "p_brand"],
    "trade": ["dim_1", "dim_2", "dim_3", "dim_4"],
    "pairs": ["n_name", "n_name_1"],
    "ranked_pairs": ["rank_1", "rank_2"],
    "coded": ["p_type"],
    "order_stats": ["c_mktsegment", "o_orderpriority"],
    "balance": ["n_name"],
    "total": [],
    "ratio": ["event_type"],
    "padded": ["dim_1", "dim_2"],
    "shipments": ["l_returnflag", "l_linestatus", "dim_3", "dim_4"],
}


def scan(symbol: str) -> str:
    """All records of a symbol with their markers."""
    dimensions = DIMENSIONS[symbol]
    if len(dimensions) < 2:
        return SYMBOLS[symbol]
    first = f"ROW_NUMBER() OVER (PARTITION BY {dimensions[0]} ORDER BY {', '.join(dimensions[1:])}) = 1"
    return f"SELECT *, ({first}) AS is_sparse_break, NOT ({first}) AS is_dense_run FROM ({SYMBOLS[symbol]}) records"


def page(symbol: str, offset: int, limit: int, where: str = "TRUE") -> str:
    order = ", ".join(DIMENSIONS[symbol])
    return (
        f"SELECT * FROM ({scan(symbol)}) scanned WHERE {where} "
        f"ORDER BY {order} LIMIT {limit} OFFSET {offset}"
    )


def catalog(descriptions: dict[str, tuple[str, str, str]]) -> str:
    """Catalog rows from (type, description, comma-separated labels) by symbol."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS symbol_name, '{kind}' AS symbol_type, "
        f"CAST({len(DIMENSIONS[name])} AS BIGINT) AS dimension_count, "
        f"CAST((SELECT COUNT(*) FROM ({SYMBOLS[name]}) r) AS BIGINT) AS record_count, "
        f"'{description}' AS description, '{labels}' AS domain_labels"
        for name, (kind, description, labels) in descriptions.items()
    )
