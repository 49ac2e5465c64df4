"""A container of symbols that live in the session, each a lazy view over a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.functions.naming import type_name
from symgrid.functions.records import distinct_labels, order_columns, ranked_dimensions, to_records
from symgrid.functions.values import same_label
from symgrid.model import CATALOG_DDL, SymbolMeta, checked_labels
from symgrid.operators.markers import with_breaks
from symgrid.operators.positions import key_at, not_after, not_before
from symgrid.sources.shared import new_folder


class SymbolSet:
    """Symbols registered over DataFrames; nothing is computed or copied on registration or when a scan is built, deep pages apart.

    Labels must not be NULL or blank: a scan that meets one fails. Keys must be unique: reading
    the markers compares neighbours in key order, and fails on a repeated one.
    """

    #: Pages that end within so many rows are a top-k of the live source.
    TOP = 100_000

    def __init__(self, spark: SparkSession, name: str = "session"):
        self.spark = spark
        self.name = name
        self._metas: dict[str, SymbolMeta] = {}
        self._records: dict[str, DataFrame] = {}
        self._copies: dict[str, dict[tuple, DataFrame]] = {}

    def register(
        self,
        df: DataFrame,
        name: str,
        symbol_type: int | str,
        dims: Sequence[str | Column],
        values: str | Column | Mapping[str, str | Column] | None = None,
        domain_labels: Sequence[str] | None = None,
        description: str = "",
        label_rank: Mapping | None = None,
        clean_labels: bool = False,
    ) -> SymbolMeta:
        """Declare a symbol over ``df``; arguments as in :func:`symgrid.write_symbol`.

        ``clean_labels`` says that the labels of ``df`` have no white space around them, and none is NULL or blank. Then dimensions
        are the bare columns, so that filters on them are pushed to the source's scan and unused ones are not read.
        Without it labels are trimmed and checked wherever a scan reads them, which no scan can be pushed through.
        """
        kind = type_name(symbol_type)
        if kind == "Alias":
            raise ValueError("Use register_alias for an alias")
        records = to_records(df, kind, dims, values, label_rank, name, clean_labels)
        meta = SymbolMeta(
            name=name,
            symbol_type=kind,
            domain_labels=checked_labels(len(dims), domain_labels),
            description=description,
            ranked=tuple(sorted(ranked_dimensions(dims, label_rank))),
        )
        return self._add(meta, records)

    def register_alias(self, name: str, target: str) -> SymbolMeta:
        """Declare another name for a symbol; it shows in the catalog but cannot be scanned."""
        symbol = self.find(target)
        return self._add(replace(symbol, name=name, symbol_type="Alias"), self._records[symbol.name.lower()])

    def _add(self, meta: SymbolMeta, records: DataFrame) -> SymbolMeta:
        key = meta.name.lower()
        old = self._metas.get(key)
        self._metas[key] = replace(meta, index=old.index if old else len(self._metas) + 1)
        self._records[key] = records
        self._copies.pop(key, None)
        return self._metas[key]

    def __str__(self) -> str:
        return self.name

    # -- what the operators need from a container ---------------------------------

    def metas(self) -> list[SymbolMeta]:
        return sorted(self._metas.values(), key=lambda meta: meta.index)

    def find(self, symbol: str) -> SymbolMeta:
        meta = self._metas.get(symbol.lower())
        if meta is None:
            raise ValueError(f"Symbol '{symbol}' not found in '{self.name}'")
        return meta

    def reload(self, force: bool = False) -> None:
        """Metadata of a session container is always current; ``force`` drops the copies that deep pages were cut from."""
        if force:
            self._copies.clear()

    def records(self, meta: SymbolMeta) -> DataFrame:
        return self._records[meta.name.lower()]

    def scan(self, meta: SymbolMeta, filters: Sequence[tuple[int, str]] = (), ignore_case: bool = False) -> DataFrame:
        """Records with the given labels, pairs of a 0-based dimension and a label; markers are a column of the whole symbol's."""
        records = self.records(meta)
        if meta.dimension_count > 1:
            records = with_breaks(records, meta.keys, self.order(meta), meta.name)
        for position, label in filters:
            records = records.where(same_label(F.col(meta.keys[position]), label, ignore_case))
        return records

    def order(self, meta: SymbolMeta) -> list[str]:
        return order_columns(meta.dimension_count, meta.ranked)

    def labels(self, meta: SymbolMeta, position: int) -> DataFrame:
        """Distinct labels of one dimension, unsorted, in column ``value``."""
        return self.records(meta).select(F.col(meta.keys[position]).alias("value")).distinct()

    def all_labels(self, meta: SymbolMeta) -> DataFrame:
        """Distinct labels of all dimensions: ``dim_index`` (1-based), ``value``."""
        return distinct_labels(self.records(meta), meta.keys)

    def catalog(self) -> DataFrame:
        """One row per symbol; the counts are one aggregate per symbol, run together."""
        rows = [
            self._records[meta.name.lower()]
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(
                F.lit(meta.name).alias("symbol_name"),
                F.lit(meta.symbol_type).alias("symbol_type"),
                F.lit(meta.dimension_count).cast("bigint").alias("dimension_count"),
                "record_count",
                F.lit(meta.description).alias("description"),
                F.array(*[F.lit(label) for label in meta.domain_labels]).cast("array<string>").alias("domain_labels"),
                F.lit(meta.index).alias("symbol_index"),
            )
            for meta in self.metas()
        ]
        if not rows:
            return self.spark.createDataFrame([], CATALOG_DDL + ", symbol_index int")
        return reduce(DataFrame.unionByName, rows)

    def page(
        self,
        meta: SymbolMeta,
        filters: Sequence[tuple[int, str]],
        ignore_case: bool,
        offset: int,
        limit: int | None,
    ) -> DataFrame:
        """The records after ``offset``, at most ``limit`` of them.

        A page that ends within TOP rows is a top-k of the live source, and nothing runs before it is asked for. A
        deeper one needs to know where it starts: the records are written to the shared folder once, and the page is what lies between
        the keys of its first and last row there. Further pages of the same filters are cut from the same copy, so they
        tile it whatever the source does meanwhile, until the symbol is registered again or :meth:`reload` drops it.
        """
        scan = self.scan(meta, filters, ignore_case)
        if limit == 0:
            return scan.where(F.lit(False))
        if not meta.dimension_count:
            return scan.limit(1 if limit is None else limit) if not offset else scan.where(F.lit(False))
        order = self.order(meta)
        if limit is not None and offset + limit <= self.TOP:
            return self._top(scan, order, offset, limit)
        copied = self._copy(meta, scan, (*sorted(filters), ignore_case))
        first = key_at(copied, order, offset)
        if first is None:
            return copied.where(F.lit(False))
        page = copied.where(not_before(copied, order, first))
        if limit is None:
            return page
        if limit <= self.TOP:
            return self._top(page, order, 0, limit)
        last = key_at(copied, order, offset + limit - 1)
        return page if last is None else page.where(not_after(copied, order, last))

    @staticmethod
    def _top(scan: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
        top = scan.orderBy(*order).limit(offset + limit)
        return top.offset(offset) if offset else top

    def _copy(self, meta: SymbolMeta, scan: DataFrame, filters: tuple) -> DataFrame:
        """The records of a scan as they were when a deep page of it was first asked for."""
        copies = self._copies.setdefault(meta.name.lower(), {})
        if filters not in copies:
            folder = new_folder(self.spark, "session-pages")
            scan.write.parquet(folder)
            copies[filters] = self.spark.read.schema(scan.schema).parquet(folder)
        return copies[filters]

    def in_order(self, meta: SymbolMeta, records: DataFrame, offset: int, limit: int | None) -> DataFrame:
        return records.orderBy(*self.order(meta)) if meta.dimension_count else records
