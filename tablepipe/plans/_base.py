"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver's tables.
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

REGISTRY: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query ``fn(spark, sf_dir) -> DataFrame`` with its DuckDB oracle."""
    def wrap(fn):
        if name in REGISTRY:
            raise KeyError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return wrap


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]
LINEITEM_ORDER = ", ".join(LINEITEM_COLS)
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
