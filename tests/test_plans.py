"""The physical plans that the design counts on."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import symgrid as sg
from symgrid.functions.records import distinct_labels
from symgrid.sources.store import SymbolStore
from symgrid.sources.views import register_views


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = SymbolStore(spark, str(tmp_path_factory.mktemp("plans") / "model"))
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 10)).alias("a"),
        (F.col("id") % 20).alias("b"),
        F.col("id").alias("c"),
        F.col("id").cast("double").alias("v"),
    )
    sg.write_symbol(df, store, "x", "Variable", ["a", "b", "c"], "v", ["a", "b", "c"], num_partitions=4)
    return store


def plan(df):
    execution = df._jdf.queryExecution()
    return df.sparkSession._jvm.PythonSQLUtils.explainString(execution, "formatted")


def test_scan_has_no_shuffle_and_is_one_codegen_span(spark, store):
    text = plan(sg.read_symbol(spark, store, "x"))
    assert "Exchange" not in text and "Window" not in text and "Join" not in text
    assert "codegen id : 1" in text and "codegen id : 2" not in text


def test_filters_reach_the_scan(spark, store):
    text = plan(sg.read_symbol(spark, store, "x", {"a": "hot", "b": "3"}))
    assert "EqualTo(key_1,hot)" in text and "EqualTo(key_2,3)" in text
    text = plan(sg.read_symbol(spark, store, "x").where("a = 'hot' AND level > 5"))
    assert "EqualTo(key_1,hot)" in text and "GreaterThan(level,5.0)" in text
    text = plan(sg.read_symbol(spark, store, "x", {"c": "HOT"}, ignore_case=True))
    assert "lower(key_3" in text and "dynamicpruning" in text.lower()


def test_sql_function_filters_reach_the_scan(spark, store):
    register_views(spark, store, "plans_")
    text = plan(spark.sql("SELECT level FROM read_plans_x(dimension_filters => map(' A', 'hot', 'C', '7'))"))
    assert "EqualTo(key_1,hot)" in text and "EqualTo(key_3,7)" in text
    assert "raise_error" not in text
    assert "ReadSchema: struct<key_1:string,key_3:string,level:double>" in text
    text = plan(spark.sql("SELECT value FROM domain_values_plans_x(2, map('a', 'hot'))"))
    assert "Union" not in text and "ReadSchema: struct<key_1:string,key_2:string>" in text
    text = plan(spark.sql("SELECT value FROM domain_values_plans_x(2)"))
    assert "Union" not in text and re.search(r"PartitionFilters: .*dim_index#\d+ = 2\)", text)


def test_columns_are_pruned(spark, store):
    text = plan(sg.read_symbol(spark, store, "x", value_columns=["upper"]).select("b", "upper"))
    assert "ReadSchema: struct<key_2:string,upper:double>" in text
    # Markers are a stored column: pruned when unused, no window when used.
    assert "first_of_run" not in plan(sg.read_symbol(spark, store, "x").select("a"))


def test_cascading_domain_values_aggregate_before_the_shuffle(spark, store):
    text = plan(sg.domain_values(spark, store, "x", "b", {"a": "hot"}))
    assert "ReadSchema: struct<key_1:string,key_2:string>" in text
    steps = [line.split("(")[0].strip(" +-*") for line in text.split("\n\n(1)")[0].splitlines() if "(" in line]
    assert steps[-4:-1] == ["HashAggregate", "Exchange", "HashAggregate"] or (
        steps[steps.index("HashAggregate") :][:3] == ["HashAggregate", "Exchange", "HashAggregate"]
    )


def test_page_is_a_pushed_range(spark, store):
    text = plan(sg.read_symbol(spark, store, "x", row_offset=400, row_limit=10))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    text = plan(sg.read_symbol(spark, store, "x", row_offset=10, row_limit=10))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(pos,10\), LessThanOrEqual\(pos,19\)", text)
    text = plan(sg.read_symbol(spark, store, "x", row_offset=400, row_limit=300))
    assert re.search(r"PartitionFilters: .*part#\d+ >= \d+.*part#\d+ <= \d+", text)


def test_write_shuffles_records_once(spark, store):
    """One exchange by part and one sort, which the window and the writer both use."""
    df = spark.range(1000).select(F.col("id").alias("c"), (F.col("id") % 3).alias("a"), F.lit(1.0).alias("v"))
    container = sg.SymbolSet(spark)
    meta = replace(container.register(df, "w", "Parameter", ["a", "c"], "v"), folder="test")
    text = plan(store._in_stored_order(container.records(meta), meta, 4, 1000))
    tree = text.split("\n\n(1)")[0]
    assert tree.count("Exchange") == 1 and tree.count("Sort") == 1 and tree.count("Window") == 1 and "Join" not in tree


def test_write_moves_records_without_the_list_of_ranges(spark, store):
    """A record takes along its part and whether it may start a label, not an array as long as there are parts; drawn keys are a set."""
    df = spark.range(1000).select(F.col("id").alias("c"), (F.col("id") % 3).alias("a"), F.lit(1.0).alias("v"))
    container = sg.SymbolSet(spark)
    meta = replace(container.register(df, "w", "Parameter", ["a", "c"], "v"), folder="test")
    text = plan(store._in_stored_order(container.records(meta), meta, 4, 1000))
    moved = re.search(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text).group(1)
    assert "at_start#" in moved and "starts#" not in moved and "bounds#" not in moved
    assert "collect_set(" in text and "array_distinct(collect_list(" not in text


def test_filter_prunes_partitions_by_the_whole_key(spark, store):
    text = plan(sg.read_symbol(spark, store, "x", {"a": "hot", "b": "3"}))
    assert re.search(r"PartitionFilters: .*part#\d+ >= \d+.*part#\d+ <= \d+", text) and "Join" not in text
    assert "EqualTo(key_1,hot)" in text


def test_filter_on_a_later_dimension_prunes_by_the_index(spark, store):
    text = plan(sg.read_symbol(spark, store, "x", {"c": "7"}))
    assert "dynamicpruning" in text.lower() and "EqualTo(key_3,7)" in text and "EqualTo(value,7)" in text


def test_page_of_a_sql_call_is_the_page_of_the_python_call(spark, store):
    register_views(spark, store, "plans_")
    text = plan(spark.sql("SELECT a, level FROM read_plans_x(row_offset => 10, row_limit => 10)"))
    assert "Union" not in text and "raise_error" not in text and "GreaterThanOrEqual(pos,10), LessThanOrEqual(pos,19)" in text
    assert "ReadSchema: struct<pos:bigint,key_1:string,level:double>" in text
    text = plan(spark.sql("SELECT * FROM read_plans_x(map('b', '3'), value_columns => array('upper'))"))
    assert "Union" not in text and "level:double" not in text and "upper:double" in text and "EqualTo(key_2,3)" in text


def test_domains_take_one_shuffle(spark, store):
    meta = store.find("x")
    text = plan(distinct_labels(store.records(meta), meta.keys).sortWithinPartitions("dim_index", "value"))
    assert text.split("\n\n(1)")[0].count("Exchange") == 1


def test_session_markers_read_the_source_once(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(100).select((F.col("id") % 2).alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("v")).write.parquet(path)
    container = sg.SymbolSet(spark)
    container.register(spark.read.parquet(path), "s", "Parameter", ["a", "b"], "v")
    scan = sg.read_symbol(spark, container, "s", {"dim_2": "4"})
    tree = plan(scan).split("\n\n(1)")[0]
    assert tree.count("Scan parquet") == 1 and "Join" not in tree
    assert [(r.dim_1, r.is_sparse_break) for r in scan.collect()] == [("0", False)]
    # No window, if the markers are not used.
    text = plan(sg.read_symbol(spark, container, "s").select("dim_1", "value"))
    assert "Exchange" not in text and "Window" not in text
