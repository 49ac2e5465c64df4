"""SQL functions and views over a store: the rules of the Python calls, pages, and overwrites."""

import pytest
from pyspark.sql import functions as F

import symgrid as sg
from symgrid.sources.store import SymbolStore
from symgrid.sources.views import register_views

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = SymbolStore(spark, str(tmp_path_factory.mktemp("sql") / "model"))
    df = spark.range(400).selectExpr("concat('a', id % 4) AS i", "format_string('%03d', id) AS j", "CAST(id AS DOUBLE) AS v")
    sg.write_symbol(df, store, "p", "Parameter", ["i", "j"], "v", COLUMNS, num_partitions=5)
    register_views(spark, store, "t_")
    return store


@pytest.mark.parametrize(
    ("python", "sql", "message"),
    [
        ({"a": None}, "map('a', CAST(NULL AS STRING))", "may not contain NULL"),
        ({"a": " \t"}, "map('a', ' \\t')", "values must contain at least one non-whitespace"),
        ({" ": "x"}, "map(' ', 'x')", "keys must contain at least one non-whitespace"),
        ({"a": "a1", "A ": "a2"}, "map('a', 'a1', 'A ', 'a2')", "Duplicate dimension filter supplied for 'a'"),
        ({"x": "1"}, "map('x', '1')", "Unknown dimension 'x' supplied.*Valid dimensions: a, b"),
    ],
)
def test_bad_filters_fail_alike(spark, store, python, sql, message):
    with pytest.raises(ValueError, match=message):
        sg.read_symbol(spark, store, "p", python)
    for call in (f"read_t_p({sql})", f"domain_values_t_p(1, {sql})"):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM {call}").collect()


@pytest.mark.parametrize(
    ("python", "sql"),
    [({" A\t": "a1 "}, "map(' A\\t', 'a1 ')"), ({"a": "a1", "b": "\n005"}, "map('a', 'a1', 'b', '\\n005')"), ({"b": "none"}, "map('b', 'none')"), ({}, "map()")],
)
def test_good_filters_find_the_same(spark, store, python, sql):
    want = sorted(map(tuple, sg.read_symbol(spark, store, "p", python).collect()))
    assert sorted(map(tuple, spark.sql(f"SELECT * FROM read_t_p({sql})").collect())) == want
    labels = [r.value for r in sg.domain_values(spark, store, "p", 2, python).collect()]
    assert [r.value for r in spark.sql(f"SELECT * FROM domain_values_t_p(2, {sql})").collect()] == labels


@pytest.mark.parametrize(("offset", "limit"), [(0, 5), (77, 100), (350, 100), (400, 3), (5, 0)])
def test_page(spark, store, offset, limit):
    want = [tuple(r) for r in sg.read_symbol(spark, store, "p", row_offset=offset, row_limit=limit).collect()]
    got = spark.sql(f"SELECT * FROM page_t_p(row_offset => {offset}, row_limit => {limit})")
    assert [tuple(r) for r in got.collect()] == want
    whole = spark.sql(f"SELECT * FROM read_t_p(row_offset => {offset}, row_limit => {limit})")
    assert [tuple(r) for r in whole.collect()] == want
    assert "Join" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize(("offset", "limit"), [(30, 40), (100, 3), (20, None), (None, 7)])
@pytest.mark.parametrize(("python", "sql"), [({"a": "a1"}, "map('a', 'a1')"), ({"a": "A1"}, "map('a', 'A1')"), ({"b": "005"}, "map('b', '005')"), (None, "NULL")])
def test_filters_and_page_in_one_call(spark, store, monkeypatch, offset, limit, python, sql):
    monkeypatch.setattr(SymbolStore, "BLOCK_ROWS", 16)
    fold = sql == "map('a', 'A1')"
    want = sg.read_symbol(spark, store, "p", python, row_offset=offset, row_limit=limit, ignore_case=fold).collect()
    number = lambda value: "NULL" if value is None else value
    call = f"read_t_p(dimension_filters => {sql}, row_offset => {number(offset)}, row_limit => {number(limit)}, ignore_case => {fold})"
    got = spark.sql(f"SELECT * FROM {call}").collect()
    assert got == want and (python is None or want == sorted(want))


def test_null_arguments_are_not_given(spark, store):
    assert spark.sql("SELECT * FROM read_t_p(NULL, NULL, NULL, NULL, NULL)").count() == 400
    assert spark.sql("SELECT * FROM read_t_p(CAST(NULL AS MAP<STRING, STRING>))").count() == 400
    assert spark.sql("SELECT * FROM page_t_p(row_offset => NULL, row_limit => NULL)").count() == 400
    assert spark.sql("SELECT * FROM domain_values_t_p(1, NULL)").count() == 4


@pytest.mark.parametrize("label", ["a1\x01", "zz\x02", "a1\x01x", "\x01", "a\x1c1"])
def test_labels_of_any_characters(spark, tmp_path, label):
    """No character stands for anything else in a filter, neither in Python nor in SQL."""
    path = str(tmp_path / "m")
    df = spark.createDataFrame([(label, "x", 1.0), ("a1", "y", 2.0), ("zz", "z", 3.0)], "i string, j string, v double")
    sg.write_symbol(df, path, "p", "Parameter", ["i", "j"], "v", ["i", "j"])
    register_views(spark, path, "odd_")
    for wanted, values in ((label, [1.0]), ("a1", [2.0]), (f"{label}{label}", [])):
        assert [r.value for r in sg.read_symbol(spark, path, "p", {"i": wanted}).collect()] == values
        text = "".join(f"\\u{ord(c):04x}" for c in wanted)
        assert [r.value for r in spark.sql(f"SELECT value FROM read_odd_p(map('i', '{text}'))").collect()] == values
    with pytest.raises(Exception, match="Unknown dimension"):
        spark.sql("SELECT * FROM read_odd_p(map('i\\u0001j', 'x'))").collect()


def test_value_columns_in_sql(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("a", "x", 1.0, 2.0)], "i string, j string, l double, u double")
    sg.write_symbol(df, path, "v", "Variable", ["i", "j"], {"level": "l", "upper": "u"})
    register_views(spark, path, "val_")
    row = spark.sql("SELECT * FROM read_val_v(value_columns => array('upper'))").first()
    assert (row.upper, row.level, row.dim_1, row.is_sparse_break) == (2.0, None, "a", True)
    assert spark.sql("SELECT level FROM read_val_v(value_columns => CAST(array() AS ARRAY<STRING>))").first().level == 1.0
    for sql, python, message in (
        ("array('level', NULL)", ["level", None], "may not contain NULL entries"),
        ("array('size')", ["size"], "Unknown value column 'size' for symbol 'v'"),
        ("array('level', 'level')", ["level", "level"], "Duplicate value column 'level'"),
    ):
        with pytest.raises(ValueError, match=message):
            sg.read_symbol(spark, path, "v", value_columns=python)
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM read_val_v(value_columns => {sql})").collect()


def test_domain_values_by_name(spark, store):
    want = [r.value for r in sg.domain_values(spark, store, "p", "b", {"a": "a1"}).collect()]
    for dimension in ("2", "'2'", "'b'", "' B '"):
        assert [r.value for r in spark.sql(f"SELECT * FROM domain_values_t_p({dimension}, map('a', 'a1'))").collect()] == want
    assert [r.value for r in spark.sql("SELECT * FROM domain_values_t_p('b', map('a', 'A1'), true)").collect()] == want
    for dimension, message in (("'c'", "Dimension 'c' not found in symbol 'p'. Available dimensions: a, b"), ("3", "Dimension index 3 out of range"), ("0", "index 0 out")):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM domain_values_t_p({dimension})").collect()


def test_preload_and_assertion_in_sql(spark, store):
    assert spark.sql("SELECT * FROM preload_t_symbols(symbol => 'P')").first().success
    assert spark.sql("SELECT * FROM preload_t_symbols()").first().success
    with pytest.raises(Exception, match="Symbol 'missing' not found in '.*model'"):
        spark.sql("SELECT * FROM preload_t_symbols('missing')").collect()
    with pytest.raises(Exception, match="symbol parameter to preload cannot be NULL"):
        spark.sql("SELECT * FROM preload_t_symbols(NULL)").collect()


def test_session_symbols_in_sql(spark):
    container = sg.SymbolSet(spark)
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "i string, j string, v double")
    container.register(df, "q", "Parameter", ["i", "j"], "v")
    register_views(spark, container, "live_s_")
    assert [r.value for r in spark.sql("SELECT * FROM read_live_s_q(map('dim_1', 'B'), ignore_case => true)").collect()] == [2.0]
    with pytest.raises(Exception, match="need a stored symbol"):
        spark.sql("SELECT * FROM read_live_s_q(row_limit => 1)").collect()


def test_page_without_limit_and_bad_bounds(spark, store):
    assert spark.sql("SELECT * FROM page_t_p(row_offset => 390)").count() == 10
    with pytest.raises(Exception, match="offset must be non-negative"):
        spark.sql("SELECT * FROM page_t_p(row_offset => -1)").collect()
    order = spark.sql("SELECT value FROM records_t_p ORDER BY stored_part, stored_pos LIMIT 3 OFFSET 1").collect()
    assert [r.value for r in order] == [4.0, 8.0, 12.0]


def test_views_follow_an_overwrite(spark, tmp_path):
    path = str(tmp_path / "m")
    one = spark.createDataFrame([("a", "x", 1.0)], "i string, j string, v double")
    sg.write_symbol(one, path, "p", "Parameter", ["i", "j"], "v")
    register_views(spark, path, "live_")
    assert spark.sql("SELECT sum(value) FROM live_p").first()[0] == 1.0
    two = one.union(one.withColumn("i", F.lit("b")))
    sg.write_symbol(two, path, "p", "Parameter", ["i", "j"], "v", ["i", "*"], mode="overwrite")
    sg.write_set(two.select("i"), path, "s", "", "i")
    assert spark.sql("SELECT sum(value) FROM live_p WHERE i IN ('a', 'b')").first()[0] == 2.0
    assert spark.sql("SELECT count(*) FROM read_live_p(map('i', 'b'))").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM live_s").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM live_symbols").first()[0] == 2
