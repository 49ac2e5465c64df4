"""Symbols over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symgrid.sources.session import SymbolSet
from symgrid.sources.shared import new_folder
from symgrid.sources.store import SymbolStore


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str) -> Column:
    """Exact decimal, so that sums do not depend on the order of the rows."""
    return F.col(column).cast("decimal(12,2)")


def _double(column: Column) -> Column:
    return column.cast("double")


def _statistics(column: str) -> list[Column]:
    total = _double(F.sum(_cents(column)))
    return [
        total.alias("level"),
        (total / F.count(F.lit(1))).alias("marginal"),
        F.min(column).alias("lower"),
        F.max(column).alias("upper"),
        F.lit(1.0).alias("scale"),
    ]


_FIVE = {name: name for name in ("level", "marginal", "lower", "upper", "scale")}


def nations(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    df = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return dict(df=df, symbol_type="Set", dims=["n_name"], values="r_name", description="Nations and their regions")


def revenue(spark, sf_dir):
    df = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("n_name", "p_brand")
        .agg(
            _double(
                F.round(F.sum(_cents("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))), 2)
            ).alias("value")
        )
    )
    return dict(
        df=df, symbol_type="Parameter", dims=["n_name", "p_brand"], values="value",
        domain_labels=["n_name", "p_brand"], description="Revenue by supplier nation and brand",
    )


def _traded(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    origin = nation.select(F.col("n_nationkey").alias("from_key"), F.col("n_name").alias("from_nation"))
    target = nation.select(F.col("n_nationkey").alias("to_key"), F.col("n_name").alias("to_nation"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(origin, F.col("s_nationkey") == F.col("from_key"))
        .join(target, F.col("c_nationkey") == F.col("to_key"))
    )


def trade(spark, sf_dir):
    df = (
        _traded(spark, sf_dir)
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("from_nation", "to_nation", "p_brand", "l_returnflag")
        .agg(F.sum("l_quantity").alias("value"))
    )
    return dict(
        df=df, symbol_type="Parameter", dims=["from_nation", "to_nation", "p_brand", "l_returnflag"],
        values="value", description="Quantity by nations, brand and return flag",
    )


def pairs(spark, sf_dir):
    df = _traded(spark, sf_dir).groupBy("from_nation", "to_nation").agg(F.sum("l_quantity").alias("value"))
    return dict(
        df=df, symbol_type="Parameter", dims=["from_nation", "to_nation"], values="value",
        domain_labels=["n_name", "n_name"], description="Quantity between nations",
    )


def ranked_pairs(spark, sf_dir):
    """Nations in the order of their keys rather than of their names."""
    df = (
        _traded(spark, sf_dir)
        .groupBy("from_nation", "from_key", "to_nation", "to_key")
        .agg(F.sum("l_quantity").alias("value"))
    )
    return dict(
        df=df, symbol_type="Parameter", dims=["from_nation", "to_nation"], values="value",
        label_rank={"from_nation": "from_key", "to_nation": "to_key"}, description="Quantity between nations",
    )


def coded(spark, sf_dir):
    """A symbol of a type code that has no name."""
    df = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"))
    return dict(df=df, symbol_type=9, dims=["p_type"], values="parts", domain_labels=["p_type"])


def order_stats(spark, sf_dir):
    df = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", "o_orderpriority")
        .agg(*_statistics("o_totalprice"))
    )
    return dict(
        df=df, symbol_type="Variable", dims=["c_mktsegment", "o_orderpriority"], values=_FIVE,
        domain_labels=["c_mktsegment", "o_orderpriority"], description="Order totals",
    )


def balance(spark, sf_dir):
    df = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(*_statistics("c_acctbal"))
    )
    return dict(
        df=df, symbol_type="Equation", dims=["n_name"], values=_FIVE,
        domain_labels=["n_name"], description="Account balances",
    )


def total(spark, sf_dir):
    df = table(spark, sf_dir, "orders").agg(_double(F.sum(_cents("o_totalprice"))).alias("value"))
    return dict(df=df, symbol_type="Parameter", dims=[], values="value", description="Value of all orders")


def ratio(spark, sf_dir):
    value = (
        F.when(F.col("event_type") == "click", F.lit(float("inf")))
        .when(F.col("event_type") == "error", F.lit(float("nan")))
        .otherwise(F.col("sum_value"))
    )
    df = table(spark, sf_dir, "events").groupBy("event_type").agg(_double(F.sum(_cents("value"))).alias("sum_value"))
    return dict(
        df=df, symbol_type="Parameter", dims=["event_type"], values=value,
        domain_labels=["event_type"], description="Event values, some of them special",
    )


def shipments(spark, sf_dir):
    """Close to the grain of the largest table; each first label holds a third of the records."""
    df = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus", "l_orderkey", "l_partkey")
        .agg(F.sum("l_quantity").alias("value"))
    )
    return dict(
        df=df, symbol_type="Parameter", dims=["l_returnflag", "l_linestatus", "l_orderkey", "l_partkey"],
        values="value", domain_labels=["l_returnflag", "l_linestatus", "*", "*"],
        description="Quantity shipped by order and part",
    )


def padded(spark, sf_dir):
    """Labels with white space around them, as files often have."""
    blanks = F.when(F.col("n_nationkey") % 2 == 0, F.lit(" ")).otherwise(F.lit("\t"))
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey"))
    df = nation.groupBy(F.concat(blanks, "n_name", blanks).alias("nation"), "c_mktsegment").agg(
        _double(F.sum(_cents("c_acctbal"))).alias("value")
    )
    return dict(df=df, symbol_type="Parameter", dims=["nation", "c_mktsegment"], values="value", description="Balances by nation")


DEFINITIONS = {
    f.__name__: f
    for f in (nations, revenue, trade, pairs, ranked_pairs, coded, order_stats, balance, total, ratio, shipments, padded)
}


def symbol_set(spark: SparkSession, sf_dir: str, *names: str) -> SymbolSet:
    """A session container with the named symbols, all of them by default."""
    container = SymbolSet(spark, sf_dir)
    for name in names or DEFINITIONS:
        container.register(name=name, clean_labels=name != "padded", **DEFINITIONS[name](spark, sf_dir))
    return container


_stores: dict[tuple[str, str], SymbolStore] = {}


def symbol_store(spark: SparkSession, sf_dir: str, *names: str) -> SymbolStore:
    """A store in the shared folder with the named symbols, each written once per application."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _stores:
        _stores[key] = SymbolStore(spark, new_folder(spark, "store"))
    store = _stores[key]
    for name in names or DEFINITIONS:
        if not store.has(name):
            store.write(name=name, **DEFINITIONS[name](spark, sf_dir))
    return store
