"""Catalog queries: listing and table comments over tables registered from
the driver's parquet files (external tables, nothing copied)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe._util import quote_sql_string
from tablepipe.operators.catalog import catalog_facts, ensure_table
from tablepipe.operators.sinks import write_table
from tablepipe.plans._base import query, table
from tablepipe.plans.writes import ORDERS_CONTRACT
from tablepipe.session import scratch_path

LISTED_DB = "tablepipe_listing"
EXCLUDED_DB = "tiger"
COMMENT_DB = "tablepipe_comments"  # kept apart so the listing is the same in any run order
# Fixed values: (table, description, geometry, crs) registered for the listing.
LISTED = [
    ("customer", "Customers of the fixture", "POINT", "EPSG:4326"),
    ("orders", "Orders, one row per order", None, None),
    ("region", None, None, None),
]


def _register(spark, sf):
    for db in (LISTED_DB, EXCLUDED_DB):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION {quote_sql_string(scratch_path(spark, db))}")
    for name, descr, geom, crs in LISTED:
        spark.sql(f"DROP TABLE IF EXISTS {LISTED_DB}.{name}")
        props = {k: v for k, v in (("geometry", geom), ("crs", crs)) if v is not None}
        sql = (f"CREATE TABLE {LISTED_DB}.{name} USING parquet "
               f"LOCATION {quote_sql_string(sf.rstrip('/') + '/' + name + '.parquet')}")
        if descr is not None:
            sql += f" COMMENT {quote_sql_string(descr)}"
        if props:
            sql += " TBLPROPERTIES (" + ", ".join(
                f"{quote_sql_string(k)} = {quote_sql_string(v)}" for k, v in props.items()) + ")"
        spark.sql(sql)
    spark.sql(f"DROP TABLE IF EXISTS {EXCLUDED_DB}.nation")
    spark.sql(f"CREATE TABLE {EXCLUDED_DB}.nation USING parquet "
              f"LOCATION {quote_sql_string(sf.rstrip('/') + '/nation.parquet')}")


def _listing_sql() -> str:
    rows = []
    for name, descr, geom, crs in LISTED:
        vals = ["'spark_catalog'", f"'{LISTED_DB}'", f"'{name}'"]
        vals += [f"'{v}'" if v is not None else "CAST(NULL AS VARCHAR)" for v in (descr, geom, crs)]
        rows.append("SELECT " + ", ".join(f"{v} AS {c}" for v, c in zip(
            vals, ["catalog", "schema", "\"table\"", "description", "geometry", "crs"]))
            + f", (SELECT count(*) FROM {name}) AS rows, (SELECT count(*) FROM (DESCRIBE {name})) AS columns")
    return " UNION ALL ".join(rows)


@query("catalog_listing", _listing_sql())
def q_catalog_listing(spark, sf):
    """The listed tables with their rows and columns, which come from the files' footers."""
    _register(spark, sf)
    facts = catalog_facts(spark, exclude=(EXCLUDED_DB,), databases=[LISTED_DB, EXCLUDED_DB])
    return facts.groupBy("catalog", "schema", "table", "description", "geometry", "crs").agg(
        F.max("rows").alias("rows"), F.count("column").alias("columns"))


# The columns of the listed tables with their Spark types.
LISTED_COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "region": "r_regionkey int, r_name string",
}


def _facts_sql() -> str:
    rows = []
    for t, columns in LISTED_COLUMNS.items():
        for c, kind in (x.split(" ") for x in columns.split(", ")):
            lo, hi = (f"CAST({f}({c}) AS DOUBLE)" if kind in ("int", "bigint", "double") else "CAST(NULL AS DOUBLE)" for f in ("min", "max"))
            rows.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{kind}' AS data_type, count(*) AS rows, "
                        f"count(*) - count({c}) AS nulls, {lo} AS min_value, {hi} AS max_value FROM {t}")
    return " UNION ALL ".join(rows)


@query("catalog_facts", _facts_sql())
def q_catalog_facts(spark, sf):
    """Rows, nulls and extremes of every column of the listed tables, from the files' footers."""
    _register(spark, sf)
    return catalog_facts(spark, exclude=(EXCLUDED_DB,), databases=[LISTED_DB, EXCLUDED_DB]).select(
        "table", "column", "data_type", "rows", "nulls", "min_value", "max_value")


@query("table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000")
def q_table_scan(spark, sf):
    """A catalog table read with two of its columns, filters in the scan."""
    _register(spark, sf)
    orders = spark.table(f"{LISTED_DB}.orders")
    return orders.where((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 1000)).select("o_orderkey", "o_totalprice")


COMMENT = "Orders loaded from the fixture; it's \"quoted\" text"


@query("table_comment",
       "SELECT 'orders_commented' AS table_name, "
       + quote_sql_string(COMMENT).replace("\\'", "''").replace('\\"', '"')
       + " AS description, count(*) AS row_count FROM orders")
def q_table_comment(spark, sf):
    """Create the table if absent, load it, then comment it (a replace drops
    comments, so the comment comes after the load)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {COMMENT_DB} "
              f"LOCATION {quote_sql_string(scratch_path(spark, COMMENT_DB))}")
    name = f"{COMMENT_DB}.orders_commented"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_table(spark, name, ORDERS_CONTRACT, location=scratch_path(spark, "orders_commented"))
    write_table(table(spark, sf, "orders"), name, contract=ORDERS_CONTRACT, existing="truncate",
                comment=COMMENT)
    descr = [t.description for t in spark.catalog.listTables(COMMENT_DB) if t.name == "orders_commented"][0]
    return spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("orders_commented").alias("table_name"), F.lit(descr).alias("description"), "row_count")
