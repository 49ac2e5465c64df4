"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the tables
and the local cores. Each query is run to completion into a no-op sink; the figure is
the best of BENCH_RUNS runs (default 3), for writing the stored symbols of two.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

import symgrid as sg
from symgrid.plans.symbols import DEFINITIONS, symbol_set
from symgrid.sources.shared import new_folder
from symgrid.sources.views import register_views

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

FOUR = {"dim_1": "NATION_1", "dim_2": "NATION_2", "dim_3": "Brand#5", "dim_4": "A"}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("symgrid-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}

    def timed(name: str, action, runs: int = RUNS) -> None:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            action()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)

    spark.range(10**6).selectExpr("sum(id)").collect()
    store = sg.SymbolStore(spark, new_folder(spark, "bench"))
    session = symbol_set(spark, SF_DIR, "revenue", "trade", "shipments")
    for name in ("trade", "shipments"):
        timed(
            f"write_{name}",
            lambda name=name: store.write(name=name, mode="overwrite", **DEFINITIONS[name](spark, SF_DIR)),
            runs=2,
        )

    register_views(spark, store, "bench_")

    def read(name: str, **options) -> DataFrame:
        return sg.read_symbol(spark, store, name, **options)

    shipments = store.find("shipments").record_count
    queries = {
        "full_scan": lambda: run(read("shipments")),
        "export": lambda: read("shipments").write.parquet(new_folder(spark, "bench-export")),
        "first_page": lambda: run(read("shipments", row_limit=10_000)),
        "second_page": lambda: run(read("shipments", row_offset=10_000, row_limit=10_000)),
        "deep_page": lambda: run(read("shipments", row_offset=shipments - 20_000, row_limit=10_000)),
        "filtered_page": lambda: run(
            read("shipments", dimension_filters={"l_linestatus": "O"}, row_offset=100_000, row_limit=10_000)
        ),
        "filtered_page_again": lambda: run(
            read("shipments", dimension_filters={"l_linestatus": "O"}, row_offset=110_000, row_limit=10_000)
        ),
        "sql_page": lambda: run(
            spark.sql("SELECT * FROM page_bench_shipments(row_offset => 300000, row_limit => 10000)")
        ),
        "filter_ignore_case": lambda: run(
            read("shipments", dimension_filters={"l_returnflag": "r", "l_linestatus": "f"}, ignore_case=True)
        ),
        # Each run makes its own copy of the symbol; the page after it is cut from that copy.
        "session_deep_page": lambda: session.reload(force=True)
        or run(sg.read_symbol(spark, session, "shipments", row_offset=300_000, row_limit=10_000)),
        "session_deep_page_again": lambda: run(
            sg.read_symbol(spark, session, "shipments", row_offset=310_000, row_limit=10_000)
        ),
        "filter_last_dim": lambda: run(read("shipments", dimension_filters={"dim_4": "77"})),
        "sql_filtered_page": lambda: run(
            spark.sql(
                "SELECT * FROM read_bench_shipments(map('l_linestatus', 'O'), row_offset => 100000, row_limit => 10000)"
            )
        ),
        "filter_four_dims": lambda: run(read("trade", dimension_filters=FOUR)),
        "where_four_dims": lambda: run(
            read("trade").where(" AND ".join(f"{dim} = '{label}'" for dim, label in FOUR.items()))
        ),
        "marker_counts": lambda: run(read("shipments").groupBy("is_sparse_break").count()),
        "domain_values": lambda: run(sg.domain_values(spark, store, "shipments", 3)),
        "domain_values_cascade": lambda: run(
            sg.domain_values(spark, store, "shipments", 4, {"l_returnflag": "R", "l_linestatus": "F"})
        ),
        "symbols": lambda: run(sg.symbols(spark, store)),
        "session_scan": lambda: run(sg.read_symbol(spark, session, "revenue")),
        "session_scan_four_dims": lambda: run(sg.read_symbol(spark, session, "trade")),
        "session_filtered_sum": lambda: run(
            sg.read_symbol(spark, session, "revenue", {"p_brand": "Brand#7"}).groupBy().sum("value")
        ),
    }
    for name, action in queries.items():
        timed(name, action)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
