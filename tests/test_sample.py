"""Golden results on a small transport-like model, in the session and in a store."""

import pytest

import symgrid as sg
from symgrid.sources.views import register_views

CITIES = ["New-York", "Chicago", "Topeka"]
PLANTS = ["Seattle", "San-Diego"]
DEMAND = {"New-York": 324.0, "Chicago": 299.0, "Topeka": 274.0}
CAPACITY = {"Seattle": 350.0, "San-Diego": 600.0}
COST = {
    ("Seattle", "New-York"): 0.225, ("Seattle", "Chicago"): 0.153, ("Seattle", "Topeka"): 0.162,
    ("San-Diego", "New-York"): 0.225, ("San-Diego", "Chicago"): 0.162, ("San-Diego", "Topeka"): 0.126,
}
STORED_ORDER = list(COST)


def frames(spark):
    cost = [(p, c, PLANTS.index(p), CITIES.index(c), v) for (p, c), v in COST.items()]
    return {
        "cities": spark.createDataFrame(list(enumerate(CITIES)), "rank int, element string"),
        "plants": spark.createDataFrame(list(enumerate(PLANTS)), "rank int, element string"),
        "demand": spark.createDataFrame([(CITIES.index(c), c, v) for c, v in DEMAND.items()], "rank int, c string, v double"),
        "plant_capacity": spark.createDataFrame([(PLANTS.index(p), p, v) for p, v in CAPACITY.items()], "rank int, p string, v double"),
        "ship_cost": spark.createDataFrame(cost, "p string, c string, p_rank int, c_rank int, v double"),
    }


def session_container(spark, tmp_path):
    f = frames(spark)
    container = sg.SymbolSet(spark, "sample")
    container.register(f["cities"], "cities", "Set", ["element"], description="Set of cities", label_rank={1: "rank"})
    container.register(f["plants"], "plants", "Set", ["element"], description="Set of plants", label_rank={"element": "rank"})
    container.register(f["demand"], "demand", 1, ["c"], "v", description="City demand", label_rank={"c": "rank"})
    container.register(f["plant_capacity"], "plant_capacity", 1, ["p"], "v", description="Plant capacity", label_rank={"p": "rank"})
    container.register(
        f["ship_cost"], "ship_cost", "Parameter", ["p", "c"], "v", description="Shipping cost",
        label_rank={"p": "p_rank", "c": "c_rank"},
    )
    container.register_alias("towns", "cities")
    return container


def stored_container(spark, tmp_path):
    f = frames(spark)
    path = str(tmp_path / "sample")
    sg.write_set(f["cities"], path, "cities", "Set of cities", "element", rank="rank")
    sg.write_set(f["plants"], path, "plants", "Set of plants", "element", rank="rank")
    sg.write_parameter(f["demand"], path, "demand", "City demand", ["c"], "v", label_rank={"c": "rank"})
    sg.write_parameter(f["plant_capacity"], path, "plant_capacity", "Plant capacity", ["p"], "v", label_rank={"p": "rank"})
    sg.write_parameter(
        f["ship_cost"], path, "ship_cost", "Shipping cost", ["p", "c"], "v", label_rank={"p": "p_rank", "c": "c_rank"}
    )
    sg.write_alias(spark, path, "towns", "CITIES")
    return path


@pytest.fixture(scope="module", params=[session_container, stored_container])
def sample(request, spark, tmp_path_factory):
    return request.param(spark, tmp_path_factory.mktemp("sample"))


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_catalog(spark, sample):
    catalog = sg.symbols(spark, sample)
    assert catalog.dtypes == [
        ("symbol_name", "string"), ("symbol_type", "string"), ("dimension_count", "bigint"),
        ("record_count", "bigint"), ("description", "string"), ("domain_labels", "array<string>"),
    ]
    assert rows(catalog) == [
        ("cities", "Set", 1, 3, "Set of cities", ["*"]),
        ("plants", "Set", 1, 2, "Set of plants", ["*"]),
        ("demand", "Parameter", 1, 3, "City demand", ["*"]),
        ("plant_capacity", "Parameter", 1, 2, "Plant capacity", ["*"]),
        ("ship_cost", "Parameter", 2, 6, "Shipping cost", ["*", "*"]),
        ("towns", "Alias", 1, 3, "Set of cities", ["*"]),
    ]


def test_set(spark, sample):
    cities = sg.read_symbol(spark, sample, "Cities", ordered=True)
    assert cities.dtypes == [("dim_1", "string"), ("is_member", "boolean"), ("description", "string")]
    assert rows(cities) == [(city, True, None) for city in CITIES]
    assert cities.where("is_member").count() == 3
    assert rows(sg.read_symbol(spark, sample, "plants", {"plants": "Seattle"})) == [("Seattle", True, None)]


def test_sums(spark, sample):
    total = lambda name: sg.read_symbol(spark, sample, name, value_columns=["value"]).agg({"value": "sum"}).first()[0]
    assert total("demand") == 897.0
    assert total("PLANT_CAPACITY") == 950.0


def test_scan_in_stored_order_with_markers(spark, sample):
    cost = sg.read_symbol(spark, sample, "ship_cost", ordered=True)
    assert cost.dtypes == [
        ("dim_1", "string"), ("dim_2", "string"),
        ("is_sparse_break", "boolean"), ("is_dense_run", "boolean"), ("value", "double"),
    ]
    breaks = [True, False, False, True, False, False]
    assert rows(cost) == [(*key, b, not b, COST[key]) for key, b in zip(STORED_ORDER, breaks)]


def test_markers_can_be_left_unused(spark, sample):
    cost = sg.read_symbol(spark, sample, "ship_cost").select("dim_1", "dim_2")
    assert sorted(rows(cost)) == sorted(STORED_ORDER)


def test_filters(spark, sample):
    read = lambda filters, **options: rows(sg.read_symbol(spark, sample, "ship_cost", filters, **options))
    assert len(read({"dim_1": "Seattle"})) == 3
    assert read({"dim_1": "San-Diego", "DIM_2": " Topeka "}) == [("San-Diego", "Topeka", False, True, 0.126)]
    assert read({"dim_1": "seattle"}) == []
    assert len(read({"dim_1": "seattle"}, ignore_case=True)) == 3
    assert read({"dim_1": "Nowhere"}) == read({"dim_1": "Nowhere"}, ignore_case=True) == []
    # Markers describe the whole symbol: Chicago never starts a run.
    assert {row[2] for row in read({"dim_2": "Chicago"})} == {False}


def test_where_after_scan(spark, sample):
    cost = sg.read_symbol(spark, sample, "ship_cost")
    assert cost.where("dim_1 = 'Seattle' AND dim_2 LIKE 'New-%'").select("value").first().value == 0.225
    assert cost.where("dim_1 = 'Seattle' AND dim_1 = 'San-Diego'").count() == 0


@pytest.mark.parametrize("offset", [None, 0, 1, 2, 5, 6, 9])
@pytest.mark.parametrize("limit", [None, 0, 1, 2, 6, 20])
def test_paging(spark, sample, offset, limit):
    page = sg.read_symbol(spark, sample, "ship_cost", row_offset=offset, row_limit=limit)
    got = [row[:2] for row in rows(page)]
    start = offset or 0
    want = STORED_ORDER[start:] if limit is None else STORED_ORDER[start : start + limit]
    assert (got if limit is not None else sorted(got)) == (want if limit is not None else sorted(want))


def test_paging_counts_filtered_records(spark, sample):
    page = sg.read_symbol(spark, sample, "ship_cost", {"dim_2": "Topeka"}, row_offset=1, row_limit=5)
    assert rows(page) == [("San-Diego", "Topeka", False, True, 0.126)]


def test_skipped_record_counts_as_previous(spark, sample):
    page = sg.read_symbol(spark, sample, "ship_cost", row_offset=1, row_limit=3)
    assert [row[2] for row in rows(page)] == [False, False, True]


def test_domain_values(spark, sample):
    values = lambda *args, **options: [row.value for row in sg.domain_values(spark, sample, "ship_cost", *args, **options).collect()]
    assert values(2) == values("dim_2") == ["Chicago", "New-York", "Topeka"]
    assert values(1) == ["San-Diego", "Seattle"]
    assert values(1, {"dim_2": "Chicago"}) == ["San-Diego", "Seattle"]
    assert values(2, {"dim_2": "Topeka"}) == ["Topeka"]
    assert values(2, {"dim_1": "SEATTLE", "dim_2": "topeka"}, ignore_case=True) == ["Topeka"]
    assert values(2, {"dim_1": "x"}) == []
    # A filtered request leaves no trace in a later unfiltered one.
    assert values(1) == ["San-Diego", "Seattle"]


def test_preload(spark, sample):
    sg.preload(spark, sample)
    sg.preload(spark, sample, symbol="SHIP_COST", force_reload=True)
    with pytest.raises(ValueError, match="Symbol 'missing' not found in '"):
        sg.preload(spark, sample, symbol="missing")
    with pytest.raises(ValueError, match="cannot be NULL"):
        sg.preload(spark, sample, symbol=None)


def test_errors(spark, sample):
    with pytest.raises(ValueError, match="Symbol 'missing_symbol' not found in '"):
        sg.read_symbol(spark, sample, "missing_symbol")
    with pytest.raises(ValueError, match="Symbol 'missing_symbol' not found in '"):
        sg.domain_values(spark, sample, "missing_symbol", 1)
    with pytest.raises(ValueError, match="does not support alias symbols"):
        sg.read_symbol(spark, sample, "towns")
    with pytest.raises(ValueError, match="does not support alias symbols"):
        sg.domain_values(spark, sample, "towns", 1)
    with pytest.raises(ValueError, match="Unknown dimension"):
        sg.domain_values(spark, sample, "ship_cost", 1, {"unknown": "a"})
    with pytest.raises(ValueError, match="limit must be non-negative"):
        sg.read_symbol(spark, sample, "ship_cost", row_limit=-1)
    with pytest.raises(ValueError, match="offset must be non-negative"):
        sg.read_symbol(spark, sample, "ship_cost", row_offset=-1)


def test_require_symbol(spark, sample):
    meta = sg.require_symbol(spark, sample, "SHIP_cost")
    assert (meta.name, meta.symbol_type, meta.dimension_count) == ("ship_cost", "Parameter", 2)


def test_sql(spark, sample):
    names = register_views(spark, sample, "m_")
    assert names == ["m_symbols", "m_cities", "m_plants", "m_demand", "m_plant_capacity", "m_ship_cost"]
    first = lambda text, **args: spark.sql(text, args=args or None).first()[0]
    assert (
        first(
            "SELECT string_agg(symbol_name || '=' || record_count, ',') WITHIN GROUP (ORDER BY symbol_name) "
            "FROM m_symbols WHERE symbol_name IN ('ship_cost', 'plants', 'cities')"
        )
        == "cities=3,plants=2,ship_cost=6"
    )
    assert first("SELECT CAST(SUM(value) AS INT) FROM m_plant_capacity") == 950
    assert first("SELECT COUNT(*) FROM m_ship_cost WHERE dim_1 = :plant", plant="Seattle") == 3
    assert first("SELECT SUM(CASE WHEN is_sparse_break THEN 1 ELSE 0 END) FROM m_ship_cost") == 2
    assert first("SELECT SUM(CASE WHEN is_dense_run THEN 1 ELSE 0 END) FROM m_ship_cost") == 4
    assert first("SELECT COUNT(*) FROM read_m_ship_cost(dimension_filters => map(' Dim_1 ', 'Seattle'))") == 3
    assert first("SELECT COUNT(*) FROM read_m_ship_cost()") == 6
    assert first("SELECT COUNT(*) FROM read_m_cities(dimension_filters => map('cities', 'Topeka')) WHERE is_member") == 1
    values = lambda call: [row.value for row in spark.sql(f"SELECT value FROM domain_values_m_{call}").collect()]
    assert values("ship_cost(2)") == ["Chicago", "New-York", "Topeka"]
    assert values("ship_cost(1, dimension_filters => map('dim_2', 'Topeka'))") == ["San-Diego", "Seattle"]
    assert values("ship_cost(2, map('DIM_2', 'Topeka'))") == ["Topeka"]
    assert values("cities(1)") == sorted(CITIES)
    with pytest.raises(Exception, match=r"Dimension index 3 out of range for symbol 'ship_cost' \(has 2 dimensions"):
        values("ship_cost(3)")
    page = spark.sql("SELECT dim_1, dim_2 FROM m_ship_cost ORDER BY dim_1, dim_2 LIMIT 2 OFFSET 2")
    assert rows(page) == [("San-Diego", "Topeka"), ("Seattle", "Chicago")]
    with pytest.raises(Exception, match="Unknown dimension 'unknown'"):
        spark.sql("SELECT COUNT(*) FROM read_m_ship_cost(dimension_filters => map('unknown', 'a'))").collect()


def test_export(spark, sample, tmp_path):
    path = str(tmp_path / "export")
    sg.read_symbol(spark, sample, "ship_cost").write.mode("overwrite").parquet(path)
    exported = spark.read.parquet(path)
    assert exported.columns == ["dim_1", "dim_2", "is_sparse_break", "is_dense_run", "value"]
    assert sorted(row[:2] for row in rows(exported)) == sorted(STORED_ORDER)
