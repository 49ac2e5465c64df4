"""Stored symbols at several parts: order, positions, paging, markers, revisions, checks."""

import os
import random
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import symgrid as sg
from symgrid.operators import positions
from symgrid.sources.log import Files, Log
from symgrid.sources.store import SymbolStore


def skewed_records(count=3000, seed=7):
    """Unique three-part keys; one first label holds about half of them."""
    rng = random.Random(seed)
    keys = set()
    while len(keys) < count:
        first = "hot" if rng.random() < 0.5 else f"a{rng.randrange(40)}"
        keys.add((first, f"b{rng.randrange(30)}", str(rng.randrange(2000))))
    return [(*key, float(i)) for i, key in enumerate(sorted(keys))]


RECORDS = skewed_records()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = SymbolStore(spark, str(tmp_path_factory.mktemp("store") / "model"))
    shuffled = random.Random(1).sample(RECORDS, len(RECORDS))
    df = spark.createDataFrame(shuffled, "a string, b string, c string, v double").repartition(5)
    sg.write_symbol(df, store, "s", "Parameter", ["a", "b", "c"], "v", ["a", "b", "*"], num_partitions=7)
    return store


@pytest.fixture(scope="module")
def session(spark):
    container = sg.SymbolSet(spark)
    df = spark.createDataFrame(RECORDS, "a string, b string, c string, v double")
    container.register(df, "s", "Parameter", ["a", "b", "c"], "v", ["a", "b", "*"])
    return container


def expected():
    previous, rows = None, []
    for a, b, c, v in RECORDS:
        rows.append((a, b, c, a != previous, a == previous, v))
        previous = a
    return rows


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_full_scan_in_order(spark, store, session):
    assert rows(sg.read_symbol(spark, store, "s", ordered=True)) == expected()
    assert rows(sg.read_symbol(spark, session, "s", ordered=True)) == expected()


def test_positions_are_contiguous_and_hot_label_is_split(spark, store):
    meta = store.find("s")
    parts = store.parts(meta).orderBy("part").collect()
    assert len(parts) == 7
    assert sum(row.rows for row in parts) == len(RECORDS) == meta.record_count
    assert [row.first_row for row in parts] == [sum(p.rows for p in parts[:i]) for i in range(7)]
    hot = store.records(meta).where("key_1 = 'hot'").select("part").distinct().count()
    assert hot >= 3
    assert max(row.rows for row in parts) < len(RECORDS) / 3


@pytest.mark.parametrize(
    ("offset", "limit"),
    [(0, 1), (0, 3000), (10, 5), (428, 2), (1499, 1000), (2999, 1), (2999, 5), (3000, 5), (4000, 1), (17, 0), (2500, None), (3000, None), (0, None)],
)
def test_pages(spark, store, offset, limit):
    page = sg.read_symbol(spark, store, "s", row_offset=offset, row_limit=limit, ordered=True)
    stop = None if limit is None else offset + limit
    assert rows(page) == expected()[offset:stop]


@pytest.mark.parametrize("filters", [{"b": "b3"}, {"a": "hot"}, {"a": "hot", "b": "b1"}, {"a": "a7", "dim_3": "12"}, {"a": "none"}])
@pytest.mark.parametrize(("offset", "limit"), [(0, 7), (5, 40), (30, None), (1, 1), (10**6, 3), (0, 10**6)])
def test_filtered_pages(spark, store, session, filters, offset, limit):
    columns = {"a": 0, "b": 1, "dim_3": 2}
    matching = [r for r in expected() if all(r[columns[k]] == v for k, v in filters.items())]
    stop = None if limit is None else offset + limit
    for container in (store, session):
        page = sg.read_symbol(
            spark, container, "s", filters, row_offset=offset, row_limit=limit, ordered=True
        )
        assert rows(page) == matching[offset:stop]


def files_read(df):
    """Files that the scan of the records opened, partition pruning included."""
    df.collect()
    nodes = [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "QueryStage" in name:
            nodes.append(node.plan())
        elif name.startswith("Scan parquet") and "/records/" in node.toString() + str(node.metadata()):
            return node.metrics().apply("numFiles").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return None


@pytest.mark.parametrize("filters", [{"a": "hot"}, {"a": "a7"}, {"a": "zzz"}, {"a": "HOT"}, {"b": "b2"}, {"a": "a39", "b": "b4"}, {"a": "hot", "b": "b7"}])
def test_only_needed_parts_are_read(spark, store, filters):
    fold = filters == {"a": "HOT"}
    columns = {"a": 0, "b": 1}
    matching = [
        r for r in expected() if all((r[columns[k]].lower() == v.lower()) if fold else (r[columns[k]] == v) for k, v in filters.items())
    ]
    for offset, limit in ((None, None), (3, 20), (3, None), (0, 10**6)):
        page = sg.read_symbol(
            spark, store, "s", filters, row_offset=offset, row_limit=limit, ordered=True, ignore_case=fold
        )
        start = offset or 0
        assert rows(page) == matching[start : None if limit is None else start + limit]
    scan = sg.read_symbol(spark, store, "s", filters, ignore_case=fold)
    most = 7 if "a" not in filters else 5 if filters in ({"a": "hot"}, {"a": "HOT"}) else 2
    assert files_read(scan) <= most


def test_page_opens_its_own_parts(spark, store):
    page = sg.read_symbol(spark, store, "s", row_offset=1700, row_limit=10)
    assert rows(page) == expected()[1700:1710]
    assert files_read(page) <= 2


def test_number_of_parts(spark, monkeypatch):
    store = SymbolStore(spark, "unused")
    assert [store._part_count(n) for n in (0, 1, 50_001, 10**6, 79 * 10**6, 81 * 10**6, 10**12)] == [1, 1, 2, 8, 8, 9, 100_000]


def test_session_pages_are_alike_at_every_depth(spark):
    """One plan, built without a job; a repeated key is found wherever the page lies."""
    evaluated = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            evaluated.add(1)
            yield batch

    df = spark.range(30_000).selectExpr("format_string('%05d', id) AS i", "'x' AS j", "CAST(id AS DOUBLE) AS v")
    df = df.mapInPandas(counted, df.schema)
    container = sg.SymbolSet(spark)
    container.register(df, "p", "Parameter", ["i", "j"], "v")
    pages = {o: sg.read_symbol(spark, container, "p", row_offset=o, row_limit=10) for o in (9_990, 9_991, 29_985)}
    assert evaluated.value == 0
    for offset, page in pages.items():
        assert [r.value for r in page.collect()] == [float(v) for v in range(offset, min(offset + 10, 30_000))]
    rest = sg.read_symbol(spark, container, "p", row_offset=29_995)
    assert [r.value for r in rest.collect()] == [29995.0, 29996.0, 29997.0, 29998.0, 29999.0]
    container.register(df.union(df.where("v = 5")), "p", "Parameter", ["i", "j"], "v")
    for offset in (9_990, 9_991, 29_985):
        with pytest.raises(Exception, match="Duplicate key in symbol 'p': 00005, x"):
            sg.read_symbol(spark, container, "p", row_offset=offset, row_limit=10).collect()


def test_source_is_computed_once(spark, tmp_path):
    """So markers are right even where the source gives other records each time."""
    evaluated = spark.sparkContext.accumulator(0)

    def counted(batches):
        evaluated.add(1)
        yield from batches

    df = spark.range(300, numPartitions=1).selectExpr("concat('a', id % 3) AS i", "uuid() AS j", "rand() AS v")
    df = df.mapInPandas(counted, df.schema)
    path = str(tmp_path / "m")
    sg.write_symbol(df, path, "p", "Parameter", ["i", "j"], "v", num_partitions=4)
    assert evaluated.value == 1
    scan = sg.read_symbol(spark, path, "p", ordered=True).collect()
    assert len(scan) == 300 and sum(r.is_sparse_break for r in scan) == 3
    assert [r.dim_1 for r in scan if r.is_sparse_break] == ["a0", "a1", "a2"]
    assert not (tmp_path / "m" / "staging" / "p").exists() or not list((tmp_path / "m" / "staging" / "p").iterdir())


def test_of_two_writers_at_once_one_raises(spark, tmp_path):
    """Both see no symbol when they start; the one that commits later finds the other's."""
    path = str(tmp_path / "m")
    one = spark.createDataFrame([("a", 1.0)], "i string, v double")
    two = spark.createDataFrame([("b", 2.0), ("c", 3.0)], "i string, v double")
    first, second = SymbolStore(spark, path), SymbolStore(spark, path)
    commit = first._commit

    def other_first(meta, mode):
        second.write(two, "p", "Parameter", ["i"], "v")
        return commit(meta, mode)

    first._commit = other_first
    with pytest.raises(ValueError, match="Symbol 'p' already exists"):
        first.write(one, "p", "Parameter", ["i"], "v")
    assert sg.read_symbol(spark, path, "p").count() == 2
    # What the loser wrote is gone, what it found is whole.
    assert len(list((tmp_path / "m" / "records" / "p").iterdir())) == 1
    # To overwrite is to come after the other, whatever was there at the start.
    first._commit = lambda meta, mode: (second.write(two, "p", "Parameter", ["i"], "v", mode="overwrite"), commit(meta, mode))[1]
    assert first.write(one, "p", "Parameter", ["i"], "v", mode="overwrite").revision == 3
    assert rows(sg.read_symbol(spark, path, "p")) == [("a", 1.0)]


def test_log_numbers_are_taken_once(spark, tmp_path):
    """Many writers, threads here: every entry has a number of its own, and folds lose none."""
    folder = str(tmp_path / "catalog")

    def add(writer):
        log = Log(spark, folder)
        for k in range(30):
            log.commit(lambda entries, k=k: {"symbol_name": f"{writer}-{k}", "seen": len(entries)})

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(add, range(6)))
    last, entries = Log(spark, folder).read()
    assert last == 180 and len(entries) == 180
    assert sorted(entry["seen"] for entry in entries.values()) == list(range(180))
    names = os.listdir(folder)
    assert "000000000150.all.json" in names and "000000000050.all.json" not in names and "000000000090.json" not in names
    assert not Files(spark, folder).put_if_absent(f"{folder}/000000000180.json", "{}")


def test_put_if_absent_by_rename(spark, tmp_path):
    """On file systems other than the local one a file is moved to its name, which must be free."""
    files = Files(spark, str(tmp_path))
    files.write(f"{tmp_path}/made", "one")
    files._rename(f"{tmp_path}/made", f"{tmp_path}/taken")
    files.write(f"{tmp_path}/made", "two")
    with pytest.raises(Exception, match="FileAlreadyExists"):
        files._rename(f"{tmp_path}/made", f"{tmp_path}/taken")
    assert files.read(f"{tmp_path}/taken") == "one"


@pytest.mark.parametrize("ranks", [[("x", 1), ("x", 2), ("y", 3)], [("x", None), ("y", 1)]])
def test_bad_ranks_of_a_set(spark, tmp_path, ranks):
    df = spark.createDataFrame(ranks, "i string, r int")
    with pytest.raises(ValueError, match="Label with(out a rank|.* more than one rank): x"):
        sg.write_set(df, str(tmp_path / "m"), "s", "", "i", rank="r")


def test_repeated_key_under_two_ranks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "x", 1)], "i string, j string, r int")
    with pytest.raises(ValueError, match="Label with more than one rank: x"):
        sg.write_symbol(df, str(tmp_path / "m"), "p", "Parameter", ["i", "j"], F.lit(1.0), label_rank={"j": "r"})


def test_white_space_around_labels(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([(" x", "j", 1.0), ("y\t", "j", 2.0)], "i string, j string, v double")
    session = sg.SymbolSet(spark)
    session.register(df, "p", "Parameter", ["i", "j"], "v")
    sg.write_symbol(df, path, "p", "Parameter", ["i", "j"], "v")
    for container in (path, session):
        assert [r.value for r in sg.domain_values(spark, container, "p", 1).collect()] == ["x", "y"]
        assert [r.value for r in sg.read_symbol(spark, container, "p", {"dim_1": "y "}).collect()] == [2.0]
    bad = spark.createDataFrame([("y ", "j", 1.0), ("y", "j", 2.0), (" ", "j", 3.0)], "i string, j string, v double")
    with pytest.raises(Exception, match="Duplicate key in symbol 'q': y, j"):
        sg.write_symbol(bad.where("v < 3"), path, "q", "Parameter", ["i", "j"], "v")
    with pytest.raises(Exception, match="Blank label in symbol 'q'"):
        sg.write_symbol(bad, path, "q", "Parameter", ["i", "j"], "v")
    session.register(df.union(spark.createDataFrame([("z", None, 1.0)], df.schema)), "p", "Parameter", ["i", "j"], "v")
    with pytest.raises(Exception, match="NULL label in symbol 'p'"):
        sg.read_symbol(spark, session, "p").collect()


def jobs(spark, action):
    """Number of Spark jobs that ``action`` runs."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("tests", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("arguments", [
    {"dimension_filters": {"a": "hot", "b": "b3"}}, {"dimension_filters": {"b": "b3"}}, {"dimension_filters": {"a": "HOT"}, "ignore_case": True},
    {"row_offset": 1700, "row_limit": 10}, {"dimension_filters": {"b": "b3"}, "row_offset": 5, "row_limit": 5},
])
def test_no_job_runs_when_a_scan_is_built(spark, store, arguments):
    store.metas()
    assert jobs(spark, lambda: sg.read_symbol(spark, store, "s", **arguments)) == 0


def test_a_write_takes_few_jobs(spark, tmp_path):
    """Staging, keys drawn, one sorted write, one pass for labels; no job for bounds, counts and the catalog."""
    df = spark.range(20_000).selectExpr("concat('a', id % 7) AS i", "CAST(id AS STRING) AS j", "CAST(id AS DOUBLE) AS v")
    assert jobs(spark, lambda: sg.write_symbol(df, str(tmp_path / "m"), "p", "Parameter", ["i", "j"], "v", num_partitions=5)) <= 8


def test_index_prunes_by_later_dimensions(spark, tmp_path):
    """A label of the last dimension is in few parts, and only these are read."""
    path = str(tmp_path / "m")
    df = spark.range(6000).selectExpr("format_string('%04d', id) AS i", "concat('j', id % 3) AS j", "concat('k', id div 1000) AS k", "CAST(id AS DOUBLE) AS v")
    sg.write_symbol(df, path, "p", "Parameter", ["i", "j", "k"], "v", num_partitions=12)
    for filters, want, most in (
        ({"dim_3": "k4"}, range(4000, 5000), 4), ({"dim_2": "j1", "dim_3": "k0"}, range(1, 1000, 3), 4), ({"dim_3": "none"}, [], 0), ({"dim_2": "j0"}, range(0, 6000, 3), 12),
    ):
        scan = sg.read_symbol(spark, path, "p", filters)
        assert sorted(row.value for row in scan.collect()) == [float(v) for v in want]
        assert (files_read(scan) or 0) <= most
    scan = sg.read_symbol(spark, path, "p", {"dim_3": "K4"}, ignore_case=True)
    assert scan.count() == 1000
    shown = scan.select("value")
    assert len(shown.collect()) == 1000 and files_read(shown) <= 4


def test_index_of_many_blocks(spark, tmp_path, monkeypatch):
    """A label that a part holds in many blocks is one label, and filters find all of its records."""
    monkeypatch.setattr(SymbolStore, "INDEX_ROWS", 16)
    df = spark.range(600).selectExpr("format_string('%03d', id) AS i", "concat('j', id % 3) AS j", "concat('k', id div 100) AS k", "CAST(id AS DOUBLE) AS v")
    store = SymbolStore(spark, str(tmp_path / "m"))
    meta = store.write(df, "p", "Parameter", ["i", "j", "k"], "v", num_partitions=2)
    assert dict(store.all_labels(meta).groupBy("dim_index").count().collect()) == {1: 600, 2: 3, 3: 6}
    for filters, want in (({"dim_2": "j1", "dim_3": "k5"}, range(502, 600, 3)), ({"dim_2": "j0"}, range(0, 600, 3)), ({"dim_2": "j0", "dim_3": "none"}, [])):
        found = sg.read_symbol(spark, store, "p", filters).collect()
        assert sorted(row.value for row in found) == [float(v) for v in want]


def test_ranges_of_many_parts(spark, tmp_path):
    """Parts of about one size, a hot first label cut into several, labels and marks right at every border."""
    path = str(tmp_path / "m")
    labels = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('a', pmod(hash(id), 50)) END"
    df = spark.range(9000).selectExpr(f"{labels} AS i", "CAST(id AS STRING) AS j", "CAST(id AS DOUBLE) AS v")
    store = SymbolStore(spark, path)
    meta = store.write(df, "p", "Parameter", ["i", "j"], "v", num_partitions=30)
    parts = store.part_list(meta)
    assert sum(part["rows"] for part in parts) == 9000 and len(parts) > 20 and max(part["rows"] for part in parts) < 1200
    want = sorted(map(tuple, df.select("i", "j", "v").collect()))
    scan = sg.read_symbol(spark, store, "p", ordered=True).collect()
    assert [(r.dim_1, r.dim_2, r.value) for r in scan] == want
    assert [r.is_sparse_break for r in scan] == [k == 0 or want[k][0] != want[k - 1][0] for k in range(9000)]
    assert sum(part["low"][0] == "hot" for part in parts) > 5


@pytest.mark.parametrize("sorted_rows", [200_000, 40])
def test_deep_session_pages(spark, monkeypatch, sorted_rows):
    """Beyond TOP a page is cut from a copy, by the keys at its ends."""
    monkeypatch.setattr(positions, "SORTED", sorted_rows)
    monkeypatch.setattr(sg.SymbolSet, "TOP", 100)
    df = spark.range(4000).selectExpr("concat('a', id % 5) AS i", "CAST(id div 5 AS STRING) AS j", "CAST(id AS DOUBLE) AS v", "CAST(5 - id % 5 AS INT) AS r")
    for rank, by in ((None, lambda row: (row[0], row[1])), ({"i": "r"}, lambda row: (-int(row[0][1]), row[1]))):
        container = sg.SymbolSet(spark)
        container.register(df, "p", "Parameter", ["i", "j"], "v", label_rank=rank)
        order = sorted(({"i": r.i, "j": r.j, "v": r.v}.values() for r in df.collect()), key=lambda row: by(list(row)))
        want = [tuple(row) for row in order]
        for offset, limit in ((0, 50), (99, 1), (777, 300), (3990, 100), (3999, 1), (4000, 5), (2500, None)):
            page = sg.read_symbol(spark, container, "p", row_offset=offset, row_limit=limit).collect()
            assert [(r.dim_1, r.dim_2, r.value) for r in page] == want[offset : None if limit is None else offset + limit]
            assert all(r.is_sparse_break == (k + offset == 0 or want[k + offset - 1][0] != r.dim_1) for k, r in enumerate(page))
        some = [row for row in want if row[1] == "7"]
        page = sg.read_symbol(spark, container, "p", {"dim_2": "7"}, row_offset=2, row_limit=1000).collect()
        assert [(r.dim_1, r.dim_2, r.value) for r in page] == some[2:]


def test_deep_pages_tile_one_copy(spark, monkeypatch):
    monkeypatch.setattr(sg.SymbolSet, "TOP", 10)
    df = spark.range(300).selectExpr("CAST(id AS STRING) AS i", "uuid() AS j", "rand() AS v")
    container = sg.SymbolSet(spark)
    container.register(df, "p", "Parameter", ["j", "i"], "v")
    pages = [sg.read_symbol(spark, container, "p", row_offset=o, row_limit=100).collect() for o in (200, 0, 100)]
    assert sorted(int(row.dim_2) for page in pages for row in page) == list(range(300))
    copies = dict(container._copies["p"])
    container.reload(force=True)
    assert sg.read_symbol(spark, container, "p", row_offset=200, row_limit=100).count() == 100
    assert container._copies["p"].keys() == copies.keys() and container._copies["p"] != copies


def test_clean_labels_are_pushed(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(100).selectExpr("concat('a', id % 5) AS i", "CAST(id AS STRING) AS j", "'x' AS k", "CAST(id AS DOUBLE) AS v").write.parquet(path)
    container = sg.SymbolSet(spark)
    container.register(spark.read.parquet(path), "p", "Parameter", ["i", "j", "k"], "v", clean_labels=True)
    total = sg.read_symbol(spark, container, "p", {"dim_1": "a2"}).agg(F.sum("value").alias("total"))
    text = total._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(i,a2)" in text and "ReadSchema: struct<i:string,v:double>" in text and "Window" not in text
    assert total.first().total == sum(range(2, 100, 5))
    marked = sg.read_symbol(spark, container, "p", {"dim_2": "7"}).collect()
    assert [(r.dim_1, r.is_sparse_break) for r in marked] == [("a2", False)]


def test_pages_tile_the_symbol(spark, store):
    tiles = [rows(sg.read_symbol(spark, store, "s", row_offset=o, row_limit=700)) for o in range(0, 3500, 700)]
    assert [row for tile in tiles for row in tile] == expected()


def test_domains(spark, store, session):
    for container in (store, session):
        for dimension, column in (("a", 0), ("b", 1), (3, 2)):
            got = [r.value for r in sg.domain_values(spark, container, "s", dimension).collect()]
            assert got == sorted({r[column] for r in RECORDS})
        got = [r.value for r in sg.domain_values(spark, container, "s", "dim_3", {"a": "hot", "b": "b2"}).collect()]
        assert got == sorted({r[2] for r in RECORDS if r[:2] == ("hot", "b2")})


def test_without_domains_table(spark, tmp_path):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "i string, v double")
    sg.write_symbol(df, str(tmp_path / "m"), "p", "Parameter", ["i"], "v", build_domains=False)
    assert [r.value for r in sg.domain_values(spark, str(tmp_path / "m"), "p", 1).collect()] == ["x", "y"]


def test_literal_dimension(spark, tmp_path):
    """A constant dimension, which Spark folds out of sort and window keys."""
    path = str(tmp_path / "m")
    df = spark.range(1000).select(F.lit("only").alias("i"), F.format_string("%04d", "id").alias("j"), F.col("id").alias("v"))
    sg.write_symbol(df, path, "p", "Parameter", ["i", "j"], "v", num_partitions=5)
    scan = rows(sg.read_symbol(spark, path, "p", ordered=True))
    assert [r[4] for r in scan] == [float(i) for i in range(1000)]
    assert [r[2] for r in scan] == [True] + [False] * 999
    assert [r[4] for r in rows(sg.read_symbol(spark, path, "p", row_offset=550, row_limit=3))] == [550.0, 551.0, 552.0]
    twice = df.union(df.where("v = 77"))
    with pytest.raises(Exception, match="Duplicate key in symbol 'q': only, 0077"):
        sg.write_symbol(twice, path, "q", "Parameter", ["i", "j"], "v", num_partitions=5)


def test_empty_symbol(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([], "i string, j string, v double")
    meta = sg.write_symbol(df, path, "e", "Parameter", ["i", "j"], "v")
    assert meta.record_count == 0
    assert rows(sg.read_symbol(spark, path, "e")) == []
    assert rows(sg.read_symbol(spark, path, "e", row_offset=1, row_limit=3)) == []
    assert rows(sg.read_symbol(spark, path, "e", {"dim_1": "a"}, row_limit=3)) == []
    assert rows(sg.domain_values(spark, path, "e", 1)) == []


def test_many_spellings_of_a_label(spark, tmp_path):
    path = str(tmp_path / "m")
    data = [("ab", "x", 1.0), ("AB", "x", 2.0), ("Ab", "Y", 3.0), ("b", "x", 4.0), ("aB", "y", 5.0)]
    df = spark.createDataFrame(data, "i string, j string, v double")
    sg.write_parameter(df, path, "p", "", ["i", "j"], "v")
    session = sg.SymbolSet(spark)
    session.register(df, "p", "Parameter", ["i", "j"], "v")
    for container in (path, session):
        result = sg.read_symbol(spark, container, "p", {"dim_1": "aB", "dim_2": "X"}, ignore_case=True)
        assert sorted(r.value for r in result.collect()) == [1.0, 2.0]
        labels = sg.domain_values(spark, container, "p", 2, {"dim_1": "AB"}, ignore_case=True)
        assert [r.value for r in labels.collect()] == ["Y", "x", "y"]
        page = sg.read_symbol(spark, container, "p", {"dim_1": "ab"}, row_offset=1, row_limit=2, ignore_case=True)
        assert [r.dim_1 for r in page.collect()] == ["Ab", "aB"]


def test_input_known_to_be_empty(spark, tmp_path):
    path = str(tmp_path / "m")
    nothing = spark.range(5).where("false").select(F.col("id").alias("i"), F.col("id").alias("j"))
    for name, dims in (("two", ["i", "j"]), ("one", ["i"]), ("none", [])):
        meta = sg.write_symbol(nothing, path, name, "Parameter", dims, F.lit(1.0))
        assert meta.record_count == 0
        assert rows(sg.read_symbol(spark, path, name, row_limit=1)) == []


def test_types_and_missing_values(spark, tmp_path):
    path = str(tmp_path / "m")
    inf = float("inf")
    df = spark.createDataFrame(
        [(1, 1.0, inf, "text"), (2, float("nan"), -inf, ""), (3, None, 2.5, None)], "k int, a double, b double, t string"
    )
    sg.write_symbol(df, path, "x", "Variable", ["k"], {"level": "a", "upper": "b"})
    sg.write_symbol(df, path, "q", "Equation", ["k"], "a")
    sg.write_symbol(df, path, "n", 99, ["k"], "b")
    sg.write_symbol(df, path, "t", "Set", ["k"], "t")
    sg.write_symbol(df, path, "u", "Set", ["k"], {"is_member": "a"})
    assert rows(sg.read_symbol(spark, path, "x", ordered=True)) == [
        ("1", 1.0, None, None, None, None), ("2", None, None, None, None, None), ("3", None, None, None, 2.5, None),
    ]
    assert [r[:2] for r in rows(sg.read_symbol(spark, path, "q", ordered=True))] == [("1", 1.0), ("2", None), ("3", None)]
    assert rows(sg.read_symbol(spark, path, "n", ordered=True)) == [("1", None), ("2", None), ("3", 2.5)]
    assert rows(sg.read_symbol(spark, path, "t", ordered=True)) == [("1", True, "text"), ("2", True, None), ("3", True, None)]
    assert rows(sg.read_symbol(spark, path, "u", ordered=True)) == [("1", True, None), ("2", None, None), ("3", None, None)]
    assert [r.symbol_type for r in sg.symbols(spark, path).collect()] == ["Variable", "Equation", "Unknown", "Set", "Set"]


def test_scalar(spark, tmp_path):
    path = str(tmp_path / "m")
    sg.write_symbol(spark.createDataFrame([(2.5,)], "v double"), path, "z", "Parameter", [], "v", description="cost")
    assert rows(sg.read_symbol(spark, path, "z")) == [(2.5,)]
    assert rows(sg.read_symbol(spark, path, "z", row_offset=0, row_limit=1)) == [(2.5,)]
    assert rows(sg.read_symbol(spark, path, "z", row_offset=1, row_limit=1)) == []
    assert rows(sg.symbols(spark, path)) == [("z", "Parameter", 0, 1, "cost", [])]
    with pytest.raises(Exception, match="More than one record for scalar 'z2'"):
        sg.write_symbol(spark.range(2), path, "z2", "Parameter", [], F.col("id"))


@pytest.mark.parametrize(
    ("data", "message"),
    [
        ([("a", "b", 1.0), ("a", "b", 2.0), ("a", "c", 1.0)], "Duplicate key in symbol 'BAD': a, b"),
        ([("a", None, 1.0)], "NULL label in symbol 'BAD'"),
    ],
)
def test_bad_keys_fail_and_leave_the_old_revision(spark, tmp_path, data, message):
    path = str(tmp_path / "m")
    good = spark.createDataFrame([("a", "b", 5.0)], "i string, j string, v double")
    sg.write_symbol(good, path, "bad", "Parameter", ["i", "j"], "v")
    with pytest.raises(Exception, match=message):
        sg.write_symbol(
            spark.createDataFrame(data, "i string, j string, v double"), path, "BAD", "Parameter", ["i", "j"], "v",
            mode="overwrite",
        )
    assert rows(sg.read_symbol(spark, path, "bad")) == [("a", "b", True, False, 5.0)]


def test_label_with_two_ranks_fails(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 2)], "i string, j string, r int")
    with pytest.raises(Exception, match="Label with more than one rank: a"):
        sg.write_symbol(df, str(tmp_path / "m"), "p", "Parameter", ["i", "j"], F.lit(1.0), label_rank={"i": "r"})


def test_overwrite_keeps_place_and_replaces_records(spark, tmp_path):
    path = str(tmp_path / "m")
    one = spark.createDataFrame([("a", 1.0)], "i string, v double")
    two = spark.createDataFrame([("b", 2.0), ("c", 3.0)], "i string, v double")
    sg.write_parameter(one, path, "p", "first", ["i"], "v")
    sg.write_parameter(one, path, "q", "second", ["i"], "v")
    before = sg.read_symbol(spark, path, "p")
    with pytest.raises(ValueError, match="Symbol 'P' already exists"):
        sg.write_parameter(two, path, "P", "again", ["i"], "v")
    sg.write_parameter(two, path, "P", "again", ["i"], "v", mode="overwrite", domain_labels=["i"])
    assert [(r.symbol_name, r.record_count) for r in sg.symbols(spark, path).collect()] == [("P", 2), ("q", 1)]
    assert rows(sg.read_symbol(spark, path, "p", ordered=True)) == [("b", 2.0), ("c", 3.0)]
    # A reader of the old revision is not disturbed.
    assert rows(before) == [("a", 1.0)]


def test_preload_is_explicit(spark, tmp_path):
    """The symbol list is kept until a write in this application or a forced reload."""
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("a", 1.0)], "i string, v double")
    sg.write_parameter(df, path, "p", "", ["i"], "v")
    sg.preload(spark, path, symbol="p")
    Log(spark, f"{path}/catalog").commit(lambda entries: {**entries["p"], "description": "changed elsewhere", "revision": 2})
    assert sg.require_symbol(spark, path, "p").description == ""
    sg.preload(spark, path, force_reload=True)
    assert sg.require_symbol(spark, path, "p").description == "changed elsewhere"


def test_store_by_uri(spark, tmp_path):
    uri = f"file://{tmp_path}/m"
    df = spark.createDataFrame([("a", "b", 1.0), ("c", "d", 2.0)], "i string, j string, v double")
    sg.write_parameter(df, uri, "p", "", ["i", "j"], "v")
    assert rows(sg.read_symbol(spark, uri, "p", row_offset=1, row_limit=1)) == [("c", "d", True, False, 2.0)]
    assert rows(sg.read_symbol(spark, f"{tmp_path}/m/", "p", {"dim_1": "a"})) == [("a", "b", True, False, 1.0)]


def test_missing_store(spark, tmp_path):
    path = str(tmp_path / "missing")
    for call in (
        lambda: sg.read_symbol(spark, path, "d"),
        lambda: sg.symbols(spark, path),
        lambda: sg.preload(spark, path),
        lambda: sg.domain_values(spark, path, "d", 1),
    ):
        with pytest.raises(ValueError, match=f"Unable to open '{path}'"):
            call()


def test_one_label_on_two_dimensions(spark, tmp_path):
    path = str(tmp_path / "m")
    data = [("r", "x", "x", 1.0), ("r", "x", "y", 2.0), ("r", "y", "x", 3.0)]
    df = spark.createDataFrame(data, "d string, cols string, rws string, v double")
    sg.write_symbol(df, path, "DATA", "Parameter", ["d", "cols", "rws"], "v", ["*", "cols_all", "rows_all"])
    both = sg.read_symbol(spark, path, "data", {"cols_all": "x", "rows_all": "x"})
    assert both.select("value").collect() == [(1.0,)]
    assert sg.read_symbol(spark, path, "data").where("cols_all = 'y' AND rows_all = 'x'").first().value == 3.0


def test_awkward_names(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("a'b", "c d", 1.0)], "i string, j string, v double")
    sg.write_symbol(df, path, "odd.na/me", "Parameter", ["i", "j"], "v", ["x.y", "weird `q`"])
    result = sg.read_symbol(spark, path, "ODD.na/me", {"X.Y": "a'b", "weird `q`": "c d"})
    assert result.columns[:2] == ["x.y", "weird `q`"]
    assert rows(result) == [("a'b", "c d", True, False, 1.0)]
