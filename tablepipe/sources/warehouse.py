"""Warehouse scans over JDBC.

A plain JDBC read is one task holding one connection; a table of any size is
read as ``num_partitions`` range queries on a numeric or date column instead.
Filters and projections on the returned DataFrame are pushed into the
warehouse query by Spark. Bounds, when not given, come from one pushed-down
``min``/``max`` query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCHSIZE = 10_000


def read_warehouse(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
                   partition_column: str | None = None, num_partitions: int | None = None,
                   lower=None, upper=None, fetchsize: int = DEFAULT_FETCHSIZE,
                   properties: dict | None = None) -> DataFrame:
    """A table (``table``) or a query (``query``) of a JDBC warehouse."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetchsize), **(properties or {})}
    source = table if table is not None else f"({query}) AS q"
    if partition_column is None:
        if query is not None:
            return spark.read.format("jdbc").options(**opts, query=query).load()
        return spark.read.format("jdbc").options(**opts, dbtable=table).load()
    if lower is None or upper is None:
        bounds = (spark.read.format("jdbc").options(**opts)
                  .option("query", f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi "
                                   f"FROM {source}").load().first())
        lower, upper = bounds["lo"], bounds["hi"]
        if lower is None:  # empty source
            return spark.read.format("jdbc").options(**opts, dbtable=source).load()
    n = num_partitions or spark.sparkContext.defaultParallelism
    return (spark.read.format("jdbc").options(**opts)
            .option("dbtable", source).option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(n)).load())


def write_warehouse(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000,
                    num_connections: int | None = None, properties: dict | None = None) -> None:
    """Multi-row inserts from the writer tasks; ``num_connections`` caps the
    tasks writing at once (coalesced, no shuffle)."""
    out = df.coalesce(num_connections) if num_connections else df
    (out.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batchsize), **(properties or {}))
     .mode(mode).save())
