"""A container of symbols on a shared filesystem, as Parquet tables.

Layout under the store's path, a folder of its own for every write::

    catalog/                        numbered entries, one per write; the newest of a symbol counts (see log.py)
    staging/<symbol>/<folder>/      the source as it was evaluated, once; removed after the write
    records/<symbol>/<folder>/      part (a partition column), pos, key_1 .. key_n, first_of_run (n > 1), values
    parts/<symbol>/<folder>/        part, rows, first_row, low, high: one JSON file
    places/<symbol>/<folder>/       dim_index (a partition column), value, part, first, last, is_lead: where each label occurs

``part`` is the range of whole keys a record was written to and ``pos`` its place in it,
so ``(part, pos)`` is the stored order. ``parts`` has one row per part. It turns a row
number into such a pair, which gives every record a position without a second write of
the data and lets a deep page be read as a pushed-down range; and it holds the range of whole keys
of each part, by which a filter on the first dimensions prunes partitions. ``places`` is the index of all others: for each
label of each dimension the parts that hold it, with its first and last place in each block of records that a task of the index
pass had at once; one row of each label leads. A
symbol becomes visible by the catalog entry added last: a failed write leaves the old revision
in place, readers of the old revision are not disturbed, and of two writers at once the
later one counts, or fails if it was not to overwrite.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from operator import or_
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from symgrid.functions.naming import VALUE_COLUMNS, type_name
from symgrid.functions.places import label_places
from symgrid.functions.records import distinct_labels, order_columns, ranked_dimensions, to_records
from symgrid.functions.values import fail_when, same_label
from symgrid.model import CATALOG_DDL, SymbolMeta, checked_labels
from symgrid.operators.markers import BREAK
from symgrid.operators.positions import with_range
from symgrid.sources.log import Files, Log
from symgrid.sources.shared import remove_folder

# Sorted keys and running positions shrink to about half with these, at no cost in time.
_ENCODING = {"compression": "zstd", "parquet.writer.version": "v2"}
_PARTS_DDL = "part int, rows bigint, first_row bigint, low array<string>, high array<string>"
_PLACES_DDL = "dim_index int, value string, part int, first bigint, last bigint, is_lead boolean"
_FOUND_DDL = "dim_index int, value string, part int, first bigint, last bigint, rows bigint"

# Symbol lists already loaded, by application and store path. Like the catalog itself
# they hold one entry per symbol; a write or preload(force_reload=True) drops them.
_loaded: dict[tuple[str, str], list[SymbolMeta]] = {}
# Called with a symbol's metadata after it was written, by application and store path.
_watchers: dict[tuple[str, str], dict[object, Callable[[SymbolMeta], None]]] = {}


class SymbolStore:
    """A store at ``path``, which may be any URI that Spark can read and write."""

    # A part holds at most about this many rows, and not much less than the second
    # number just for the sake of parallel writing.
    ROWS_PER_PART = 10_000_000
    MIN_ROWS_PER_PART = 50_000
    # Keys drawn per part to choose the ranges by, and of all parts together.
    KEYS_PER_PART = 100
    KEYS_DRAWN = 1_000_000
    # Records whose labels a task looks up at once as the index is built.
    INDEX_ROWS = 1 << 19
    # Rows of a filtered page are counted by blocks of so many places to find its ends, or more places if it takes more blocks.
    BLOCK_ROWS = 1 << 14
    BLOCKS = 1_000_000
    # Filtered pages of at most so many rows find their blocks by a broadcast.
    BROADCAST_LIMIT = 1_000_000
    # Symbols whose list of parts is kept.
    PARTS_KEPT = 64

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._known_parts: dict[str, list[dict]] = {}

    def __str__(self) -> str:
        return self.path

    def _dir(self, table: str, meta: SymbolMeta) -> str:
        return f"{self.path}/{table}/{quote(meta.name.lower(), safe='')}/{meta.folder}"

    # -- catalog ------------------------------------------------------------------

    @property
    def _cache_key(self) -> tuple[str, str]:
        return (self.spark.conf.get("spark.app.id"), self.path)

    @property
    def _log(self) -> Log:
        return Log(self.spark, f"{self.path}/catalog")

    def _entries(self) -> list[dict]:
        """Newest entry of every symbol, in the order the symbols were added."""
        number, entries = self._log.read()
        if number < 0:
            raise ValueError(f"Unable to open '{self.path}'")
        return sorted(entries.values(), key=lambda entry: entry["symbol_index"])

    def catalog(self) -> DataFrame:
        """Newest revision of every symbol, with ``symbol_index`` and ``revision``."""
        columns = [field.split()[0] for field in CATALOG_DDL.split(", ")]
        rows = [tuple(entry[name] for name in (*columns, "symbol_index", "revision")) for entry in self._entries()]
        return self.spark.createDataFrame(rows, f"{CATALOG_DDL}, symbol_index int, revision int")

    def metas(self) -> list[SymbolMeta]:
        if self._cache_key not in _loaded:
            _loaded[self._cache_key] = [
                SymbolMeta(
                    name=entry["symbol_name"],
                    symbol_type=entry["symbol_type"],
                    domain_labels=tuple(entry["domain_labels"]),
                    description=entry["description"],
                    index=entry["symbol_index"],
                    record_count=entry["record_count"],
                    revision=entry["revision"],
                    folder=entry["folder"],
                    ranked=tuple(entry["ranked"]),
                )
                for entry in self._entries()
            ]
        return _loaded[self._cache_key]

    def find(self, symbol: str) -> SymbolMeta:
        for meta in self.metas():
            if meta.name.lower() == symbol.lower():
                return meta
        raise ValueError(f"Symbol '{symbol}' not found in '{self.path}'")

    def has(self, symbol: str) -> bool:
        try:
            return any(meta.name.lower() == symbol.lower() for meta in self.metas())
        except ValueError:
            return False

    def reload(self, force: bool = False) -> None:
        if force:
            _loaded.pop(self._cache_key, None)
            self.spark.catalog.refreshByPath(self.path)
        self.metas()

    # -- writing ------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        name: str,
        symbol_type: int | str,
        dims: Sequence[str | Column],
        values: str | Column | Mapping[str, str | Column] | None = None,
        domain_labels: Sequence[str] | None = None,
        description: str = "",
        label_rank: Mapping | None = None,
        mode: str = "error",
        num_partitions: int | None = None,
        build_domains: bool = True,
    ) -> SymbolMeta:
        kind = type_name(symbol_type)
        if kind == "Alias":
            raise ValueError("Use write_alias for an alias")
        meta = SymbolMeta(
            name=name,
            symbol_type=kind,
            domain_labels=checked_labels(len(dims), domain_labels),
            description=description,
            ranked=tuple(sorted(ranked_dimensions(dims, label_rank))),
        )
        records = to_records(df, kind, dims, values, label_rank, name)
        return self.write_records(records, meta, mode, num_partitions, build_domains)

    def write_records(
        self,
        records: DataFrame,
        meta: SymbolMeta,
        mode: str = "error",
        num_partitions: int | None = None,
        build_domains: bool = True,
    ) -> SymbolMeta:
        """Stage, sort into parts, index, commit. Counts and part bounds are observed as the rows are written."""
        self._check_mode(meta, mode, self._log.read()[1])
        meta = replace(meta, folder=uuid.uuid4().hex)
        staging = self._dir("staging", meta)
        try:
            staged_rows = Observation()
            records.observe(staged_rows, F.count(F.lit(1)).alias("rows")).write.parquet(staging)
            rows = staged_rows.get["rows"]
            if not meta.dimension_count and rows > 1:
                raise ValueError(f"More than one record for scalar '{meta.name}'")
            staged = self.spark.read.schema(records.schema).parquet(staging)
            self._check_ranks(staged, meta)
            written = Observation()
            in_order = self._in_stored_order(staged, meta, num_partitions or self._part_count(rows), rows)
            # One row per part reaches the driver.
            in_order.observe(
                written,
                F.count(F.lit(1)).alias("rows"),
                F.count_if(BREAK).alias("breaks"),
                F.collect_list(F.when(F.col("pos") == 0, F.struct("part", F.array(*meta.keys).cast("array<string>").alias("low")))).alias("lows"),
                F.collect_list(F.when(F.col("is_last"), F.struct("part", (F.col("pos") + 1).alias("rows")))).alias("sizes"),
            ).select(self._record_columns(meta)).write.partitionBy("part").options(**_ENCODING).parquet(self._dir("records", meta))
        finally:
            remove_folder(self.spark, staging)
        self._write_parts(meta, rows, written.get)
        self._write_domains(meta, rows, written.get["breaks"], build_domains)
        return self._commit(replace(meta, record_count=rows), mode)

    def _check_ranks(self, records: DataFrame, meta: SymbolMeta) -> None:
        """A label with two ranks would stand in two places of the stored order, one without a rank in none."""
        for position in meta.ranked:
            key, rank = f"key_{position}", f"rank_{position}"
            ranks = records.groupBy(key).agg(F.min(rank).alias("low"), F.max(rank).alias("high"), F.count_if(F.col(rank).isNull()).alias("missing"))
            bad = ranks.where((F.col("low") != F.col("high")) | (F.col("missing") > 0)).agg(F.min(F.struct(key, "missing")).alias("first")).first().first
            if bad is not None:
                problem = "Label without a rank" if bad.missing else "Label with more than one rank"
                raise ValueError(f"{problem}: {bad[key]}")

    def write_alias(self, name: str, target: str, mode: str = "error") -> SymbolMeta:
        symbol = self.find(target)
        return self._commit(replace(symbol, name=name, symbol_type="Alias", folder=""), mode)

    def _check_mode(self, meta: SymbolMeta, mode: str, entries: Mapping[str, dict]) -> dict | None:
        """The entry that a write would replace."""
        if mode not in ("error", "overwrite"):
            raise ValueError("mode must be 'error' or 'overwrite'")
        old = entries.get(meta.name.lower())
        if old and mode == "error":
            raise ValueError(f"Symbol '{meta.name}' already exists in '{self.path}'")
        return old

    def _commit(self, meta: SymbolMeta, mode: str) -> SymbolMeta:
        """Make a written symbol visible. The mode is checked against the entries that the new one follows."""

        def entry(entries: dict[str, dict]) -> dict:
            old = self._check_mode(meta, mode, entries)
            index = old["symbol_index"] if old else max((e["symbol_index"] for e in entries.values()), default=0) + 1
            return {
                "symbol_name": meta.name,
                "symbol_type": meta.symbol_type,
                "dimension_count": meta.dimension_count,
                "record_count": meta.record_count,
                "description": meta.description,
                "domain_labels": list(meta.domain_labels),
                "symbol_index": index,
                "revision": old["revision"] + 1 if old else 1,
                "folder": meta.folder,
                "ranked": list(meta.ranked),
            }

        try:
            added = self._log.commit(entry)
        except ValueError:
            if meta.folder:
                for table in ("records", "parts", "places"):
                    remove_folder(self.spark, self._dir(table, meta))
            raise
        _loaded.pop(self._cache_key, None)
        meta = replace(meta, index=added["symbol_index"], revision=added["revision"])
        for watcher in _watchers.get(self._cache_key, {}).values():
            watcher(meta)
        return meta

    @staticmethod
    def _record_columns(meta: SymbolMeta) -> list[str]:
        return ["part", "pos", *meta.keys, *([BREAK] if meta.dimension_count > 1 else []), *meta.values]

    def _in_stored_order(self, records: DataFrame, meta: SymbolMeta, parts: int, rows: int) -> DataFrame:
        """Records sorted by key and split into ranges of the whole key, with part, pos, marks and ``is_last`` of a part.

        The whole key is unique, so a ``key_1`` that holds a large share of the rows is
        cut into as many ranges as its size asks for. The records move once: each goes to the partition of its part, where
        one window in key order numbers it, compares it with the one before, and so marks first labels and finds
        repeated keys. A part whose range starts with a label starts with a first record; one that goes on with the label of the
        range before does not, since that range has a record of it.
        """
        if not meta.dimension_count:
            return records.select(
                F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("pos"), *meta.values, F.lit(False).alias(BREAK), F.lit(True).alias("is_last")
            )
        keys, order = meta.keys, order_columns(meta.dimension_count, meta.ranked)
        key, starts = F.struct(*order), F.lit(True)
        records = records.withColumn("part", F.lit(0))
        if parts > 1:
            # A scalar subquery of the same plan: the driver does not see the keys drawn.
            ranged = records.withColumn("ranges", self._ranges(records, order, parts, rows).scalar()).select("*", "ranges.*")
            ranged = with_range(ranged, "part", order, "bounds", parts - 1)
            # Told before the records move, or each would carry a list as long as there are parts.
            at_start = (F.col("part") == 0) | F.get("starts", F.col("part") - 1)
            records, starts = ranged.select(*records.columns, at_start.alias("at_start")), F.col("at_start")
        in_order = Window.partitionBy("part").orderBy(*order)
        placed = (
            records.repartitionById(parts, F.col("part"))
            .withColumns({
                "pos": F.row_number().over(in_order).cast("bigint") - 1,
                "before": F.lag(key).over(in_order),
                "is_last": F.lead("key_1").over(in_order).isNull(),
            })
        )
        before = F.col("before")
        duplicate = F.concat(F.lit(f"Duplicate key in symbol '{meta.name}': "), F.concat_ws(", ", *keys))
        return (
            placed.where(fail_when(before.isNotNull() & (before == key), duplicate))
            .withColumn(BREAK, F.when(before.isNull(), starts).otherwise(before["key_1"] != F.col("key_1")))
            .select("part", "pos", *keys, BREAK, *meta.values, "is_last")
        )

    def _ranges(self, records: DataFrame, order: Sequence[str], parts: int, rows: int) -> DataFrame:
        """One row: ``bounds``, the lowest key of each range but the first, and ``starts``, whether it is the start of a label.

        Bounds are keys drawn by hash, KEYS_PER_PART a part, so all are keys of records. One whose first label differs from that of the
        bound before is lowered to the start of its label (NULLs come first).
        """
        drawn = min(parts * self.KEYS_PER_PART, self.KEYS_DRAWN)
        few = records.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(max(1, rows // drawn))) == 0)
        # array_distinct compares structs pair by pair; a set is hashed.
        keys = few.agg(F.sort_array(F.collect_set(F.struct(*order))).alias("keys"))
        places = F.sequence(F.lit(1), F.lit(parts - 1))
        at = F.transform(places, lambda i: F.floor(i * F.size("keys") / parts).cast("int"))
        chosen = keys.select(F.transform(F.filter(F.array_distinct(at), lambda i: i > 0), lambda i: F.get("keys", i)).alias("keys"))
        label = [name for name in order if name in ("rank_1", "key_1")]
        kinds = dict(records.dtypes)

        def starts(bound: Column, i: Column) -> Column:
            return (i == 0) | (F.get("keys", i - 1)["key_1"] != bound["key_1"])

        def lowered(bound: Column) -> Column:
            return F.struct(*[bound[name].alias(name) if name in label else F.lit(None).cast(kinds[name]).alias(name) for name in order])

        return chosen.select(
            F.struct(
                F.transform("keys", lambda bound, i: F.when(starts(bound, i), lowered(bound)).otherwise(bound)).alias("bounds"),
                F.transform("keys", starts).alias("starts"),
            ).alias("ranges")
        )

    def _part_count(self, rows: int) -> int:
        at_once = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(1, -(-rows // self.ROWS_PER_PART), min(at_once, -(-rows // self.MIN_ROWS_PER_PART)))

    def _write_parts(self, meta: SymbolMeta, rows: int, seen: Mapping) -> None:
        """Rows and bounds of each part as it was written, which must be all rows that were staged."""
        lows = {low.part: list(low.low) for low in seen["lows"]}
        sizes = sorted((size.part, size.rows) for size in seen["sizes"])
        if seen["rows"] != rows or sum(size for _, size in sizes) != rows or {part for part, _ in sizes} != set(lows):
            raise RuntimeError(f"Stored positions of symbol '{meta.name}' are not those of its records")
        lines, first = [], 0
        for (part, size), after in zip(sizes, [*sizes[1:], None][: len(sizes)], strict=True):
            high = lows[after[0]] if after else None
            lines.append({"part": part, "rows": size, "first_row": first, "low": lows[part], "high": high})
            first += size
        folder = self._dir("parts", meta)
        Files(self.spark, folder).write(f"{folder}/parts.json", "".join(json.dumps(line) + "\n" for line in lines))

    def _write_domains(self, meta: SymbolMeta, rows: int, breaks: int, build: bool) -> None:
        """Labels of all dimensions with the parts they are in, from one pass over the stored keys and one exchange.

        That pass counts what is on disk, which must be what was staged, with a mark for each first label. Tasks find the places of
        labels by blocks of the records they read, so a label that many records share moves once per block.
        """
        records = self.records(meta)
        wrong = f"Stored positions of symbol '{meta.name}' are not those of its records"
        if not (build and meta.dimension_count):
            if records.count() != rows:
                raise RuntimeError(wrong)
            return
        found = records.select("part", "pos", *meta.keys).mapInArrow(label_places(meta.keys, self.INDEX_ROWS), _FOUND_DDL)
        of_label = Window.partitionBy("dim_index", "value").orderBy("part", "first")
        led = found.repartition("dim_index", "value").withColumn("is_lead", F.row_number().over(of_label) == 1)
        stored = Observation()
        counted = led.observe(
            stored,
            F.sum(F.when(F.col("dim_index") == 1, F.col("rows"))).alias("rows"),
            F.count_if((F.col("dim_index") == 1) & F.col("is_lead")).alias("labels"),
        )
        sorted_places = counted.drop("rows").sortWithinPartitions("dim_index", "value", "part", "first")
        sorted_places.write.partitionBy("dim_index").options(**_ENCODING).parquet(self._dir("places", meta))
        if (stored.get["rows"] or 0) != rows:
            raise RuntimeError(wrong)
        if breaks != stored.get["labels"]:
            raise RuntimeError(f"Markers of symbol '{meta.name}' do not match its first labels")

    def watch(self, name: object, watcher: Callable[[SymbolMeta], None]) -> None:
        """Have ``watcher`` called with every symbol that this application writes to the store; one for each name."""
        _watchers.setdefault(self._cache_key, {})[name] = watcher

    # -- what the operators need from a container ---------------------------------

    def records(self, meta: SymbolMeta) -> DataFrame:
        columns = ["part int", "pos bigint", *[f"{key} string" for key in meta.keys]]
        if meta.dimension_count > 1:
            columns.append(f"{BREAK} boolean")
        columns += [f"{name} {kind}" for name, kind in VALUE_COLUMNS[meta.symbol_type]]
        return self.spark.read.schema(", ".join(columns)).parquet(self._dir("records", meta))

    def scan(self, meta: SymbolMeta, filters: Sequence[tuple[int, str]] = (), ignore_case: bool = False) -> DataFrame:
        """Records with the given labels, pairs of a 0-based dimension and a label; markers are a column.

        Labels of the first dimensions bound the whole key, so only parts whose range can hold it are read. Any others are looked up
        in the index as the query runs: partitions without one of them, or where they lie apart, are pruned.
        The comparisons are pushed to the scan in any case; without regard to case they are made on what it reads.
        """
        records = self.records(meta)
        if not filters:
            return records
        wanted = dict(filters)
        prefix = []
        while not ignore_case and len(prefix) in wanted and len(prefix) + 1 not in meta.ranked:
            prefix.append(wanted[len(prefix)])
        parts = self.part_list(meta)
        if prefix:
            parts = self._holding(parts, prefix)
            if not parts:
                return records.where(F.lit(False))
            records = records.where(F.col("part").between(parts[0]["part"], parts[-1]["part"]))
        others = [(position, label) for position, label in filters if position >= len(prefix)]
        index = self._index(meta) if others and len(parts) > 1 else None
        if index is not None:
            records = records.join(self._indexed(index, others, ignore_case), "part", "left_semi")
        for position, label in filters:
            records = records.where(same_label(F.col(meta.keys[position]), label, ignore_case))
        return records

    @staticmethod
    def _holding(parts: list[dict], prefix: list[str]) -> list[dict]:
        """The parts, neighbours all, that may hold keys that start with these labels."""
        lows = [part["low"][: len(prefix)] for part in parts]
        first = max(0, bisect_left(lows, prefix) - 1)
        return parts[first : bisect_right(lows, prefix)]

    @staticmethod
    def _indexed(index: DataFrame, filters: Sequence[tuple[int, str]], ignore_case: bool) -> DataFrame:
        """Parts that hold all these labels, where their places overlap. Broadcast: a row is a part of the symbol."""
        conditions = [(F.col("dim_index") == position + 1) & same_label(F.col("value"), label, ignore_case) for position, label in filters]
        places = index.where(reduce(or_, conditions)).select("dim_index", "part", "first", "last")
        if len(filters) == 1:
            return F.broadcast(places.select("part").distinct())
        # The spellings of a label count as one, as do its blocks in a part.
        places = places.groupBy("dim_index", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        both = places.groupBy("part").agg(F.count(F.lit(1)).alias("found"), F.max("first").alias("first"), F.min("last").alias("last"))
        places = both.where((F.col("found") == len(filters)) & (F.col("first") <= F.col("last")))
        return F.broadcast(places.select("part"))

    def parts(self, meta: SymbolMeta) -> DataFrame:
        return self.spark.read.schema(_PARTS_DDL).json(self._dir("parts", meta))

    def part_list(self, meta: SymbolMeta) -> list[dict]:
        """The rows of ``parts`` in order, read once: a number of rows and a key for each part."""
        if meta.folder not in self._known_parts:
            folder = self._dir("parts", meta)
            lines = Files(self.spark, folder).read(f"{folder}/parts.json").splitlines()
            while len(self._known_parts) >= self.PARTS_KEPT:
                del self._known_parts[next(iter(self._known_parts))]
            self._known_parts[meta.folder] = [json.loads(line) for line in lines]
        return self._known_parts[meta.folder]

    def labels(self, meta: SymbolMeta, position: int) -> DataFrame:
        """Distinct labels of one dimension, unsorted, in column ``value``."""
        index = self._index(meta)
        if index is None:
            return self.records(meta).select(F.col(meta.keys[position]).alias("value")).distinct()
        return index.where((F.col("dim_index") == position + 1) & F.col("is_lead")).select("value")

    def all_labels(self, meta: SymbolMeta) -> DataFrame:
        """Distinct labels of all dimensions: ``dim_index`` (1-based), ``value``."""
        index = self._index(meta)
        return distinct_labels(self.records(meta), meta.keys) if index is None else index.where("is_lead").select("dim_index", "value")

    def _index(self, meta: SymbolMeta) -> DataFrame | None:
        """The places of labels, if the symbol was written with them."""
        try:
            return self.spark.read.schema(_PLACES_DDL).parquet(self._dir("places", meta))
        except AnalysisException:
            return None

    def page(
        self,
        meta: SymbolMeta,
        filters: Sequence[tuple[int, str]],
        ignore_case: bool,
        offset: int,
        limit: int | None,
    ) -> DataFrame:
        """The records after ``offset``, at most ``limit`` of them; no job runs until they are asked for.

        Without filters, the list of parts turns the page into a range of (part, pos), whatever its depth.
        """
        scan = self.scan(meta, filters, ignore_case)
        if limit == 0:
            return scan.where(F.lit(False))
        if filters:
            return self._filtered_page(meta, scan, offset, limit)
        parts = self.part_list(meta)
        start = self._place(parts, offset)
        if start is None:
            return scan.where(F.lit(False))
        stop = None if limit is None else self._place(parts, offset + limit - 1)
        part, pos = F.col("part"), F.col("pos")
        page = scan.where((part >= start[0]) & ((part > start[0]) | (pos >= start[1])))
        if stop is not None:
            page = page.where((part <= stop[0]) & ((part < stop[0]) | (pos <= stop[1])))
            if stop[0] == start[0]:
                page = page.where((pos >= start[1]) & (pos <= stop[1]))
        return page

    @staticmethod
    def _place(parts: list[dict], row: int) -> tuple[int, int] | None:
        """Part and place in it of a row number; None beyond the last row."""
        at = bisect_right(parts, row, key=lambda part: part["first_row"]) - 1
        if at < 0 or row - parts[at]["first_row"] >= parts[at]["rows"]:
            return None
        return parts[at]["part"], row - parts[at]["first_row"]

    def block_rows(self, meta: SymbolMeta) -> int:
        return max(self.BLOCK_ROWS, -(-sum(part["rows"] for part in self.part_list(meta)) // self.BLOCKS))

    def _filtered_page(self, meta: SymbolMeta, scan: DataFrame, offset: int, limit: int | None) -> DataFrame:
        """A page of filtered records, all in one plan.

        They are counted by blocks of places, from the filtered columns alone, and a running sum over the blocks gives the number
        of a block's first record. Blocks that the page touches are joined back, and their records
        numbered. The parts of these blocks prune the second scan as it runs.
        """
        block = F.expr(f"pos div {self.block_rows(meta)}")
        sizes = scan.groupBy("part", block.alias("block")).agg(F.count(F.lit(1)).alias("rows"))
        # There are at most BLOCKS blocks and parts, so this window is small.
        before = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = sizes.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        touched = blocks.where(F.col("first") + F.col("rows") > offset)
        if limit is not None:
            touched = touched.where(F.col("first") < offset + limit)
        in_block = Window.partitionBy("part", "block").orderBy("pos")
        touched = touched.select("part", "block", "first")
        if limit is not None and limit <= self.BROADCAST_LIMIT:
            # Each of these blocks but the last two has a record of the page.
            touched = F.broadcast(touched)
        joined = scan.withColumn("block", block).join(touched, ["part", "block"])
        numbered = joined.withColumn("number", F.col("first") + F.row_number().over(in_block) - 1)
        page = numbered.where(F.col("number") >= offset)
        if limit is not None:
            page = page.where(F.col("number") < offset + limit)
        return page.select(*scan.columns)

    def in_order(self, meta: SymbolMeta, records: DataFrame, offset: int, limit: int | None) -> DataFrame:
        records = records.orderBy("part", "pos")
        # A page has no more rows than this anyway; said here, it makes the sort a top-k.
        return records if limit is None else records.limit(limit)

