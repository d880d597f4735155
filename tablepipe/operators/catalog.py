"""Catalog listing, table comments and metadata capture.

The listing walks catalog metadata on the driver - its size is the number of
tables, never data rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe._util import quote_ident, quote_sql_string
from tablepipe.functions.text import json_path
from tablepipe.functions.timeops import epoch_text

LISTING_SCHEMA = ("catalog string, schema string, table string, description string, "
                  "geometry string, crs string")


def set_table_comment(spark: SparkSession, table: str, comment: str) -> None:
    """``COMMENT ON TABLE`` with the text escaped (the original did not escape)."""
    spark.sql(f"COMMENT ON TABLE {quote_ident(table)} IS {quote_sql_string(comment)}")


def ensure_table(spark: SparkSession, table: str, contract, comment: str | None = None,
                 location: str | None = None, properties: dict | None = None,
                 fmt: str = "parquet") -> None:
    """``CREATE SCHEMA/TABLE IF NOT EXISTS`` from a contract, then the comment."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_ident(table.rsplit('.', 1)[0])}")
    sql = f"CREATE TABLE IF NOT EXISTS {quote_ident(table)} ({contract.ddl()}) USING {fmt}"
    if location:
        sql += f" LOCATION {quote_sql_string(location)}"
    if properties:
        props = ", ".join(f"{quote_sql_string(k)} = {quote_sql_string(str(v))}" for k, v in properties.items())
        sql += f" TBLPROPERTIES ({props})"
    spark.sql(sql)
    if comment is not None:
        set_table_comment(spark, table, comment)


def catalog_listing(spark: SparkSession, exclude=("tiger",), databases=None, catalogs=None) -> DataFrame:
    """``(catalog, schema, table, description, geometry, crs)`` for every table
    of the given catalogs (default: the current one), leaving out the
    ``exclude`` schemas. ``geometry`` and ``crs`` come from table properties
    of those names. ``databases`` restricts the walk to those schemas."""
    current = spark.catalog.currentCatalog()
    rows = []
    for catalog in catalogs or [current]:
        if databases is not None:
            names = list(databases)
        elif catalog == current:
            names = [d.name for d in spark.catalog.listDatabases()]
        else:
            names = [r[0] for r in spark.sql(f"SHOW NAMESPACES IN {quote_ident(catalog)}").collect()]
        for db in names:
            if db in exclude:
                continue
            for t in spark.catalog.listTables(f"{catalog}.{db}" if catalog != current else db):
                if t.isTemporary:
                    continue
                full = f"{catalog}.{db}.{t.name}"
                props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {quote_ident(full)}").collect()}
                rows.append((catalog, db, t.name, t.description, props.get("geometry"), props.get("crs")))
    return spark.createDataFrame(rows, LISTING_SCHEMA)


FACTS_SCHEMA = ("schema string, table string, column string, data_type string, rows bigint, nulls bigint, "
                "min_value double, max_value double")


def table_facts(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """One row per column of a table: its type, the table's rows, the column's nulls and, for
    numbers, the least and greatest value.

    For parquet the scan answers from the file footers (row counts and column statistics,
    read by tasks); no column data is read. Other formats are scanned."""
    from pyspark.sql import types as T

    from tablepipe.operators.sinks import TableInfo, setting

    full = f"{schema}.{table}"
    info, fields = TableInfo(spark, full), spark.table(full).schema.fields
    if info.provider == "parquet" and not info.partitions:
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # read when the facts are
        with setting(spark, "spark.sql.sources.useV1SourceList", ""):  # the reader that pushes aggregates
            data = spark.read.schema(spark.table(full).schema).parquet(info.location)
    else:
        data = spark.table(full)
    number = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"n{i}"))
        if isinstance(f.dataType, number):
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    none = F.lit(None).cast("double")
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col("__rows").alias("rows"),
                     (F.col("__rows") - F.col(f"n{i}")).alias("nulls"),
                     (F.col(f"lo{i}").cast("double") if isinstance(f.dataType, number) else none).alias("min_value"),
                     (F.col(f"hi{i}").cast("double") if isinstance(f.dataType, number) else none).alias("max_value"))
            for i, f in enumerate(fields)]
    return data.agg(*aggs).select(F.lit(schema).alias("schema"), F.lit(table).alias("table"), F.inline(F.array(*rows)))


def catalog_facts(spark: SparkSession, exclude=("tiger",), databases=None) -> DataFrame:
    """The catalog listing with the facts of each table's columns, leaving out the ``exclude`` schemas."""
    from functools import reduce

    listing = catalog_listing(spark, exclude, databases)
    facts = [table_facts(spark, r["schema"], r["table"]) for r in listing.select("schema", "table").collect()]
    empty = spark.createDataFrame([], FACTS_SCHEMA)
    return listing.join(reduce(DataFrame.unionByName, facts, empty), ["schema", "table"])


# Metadata fields captured from a portal dataset, name -> dotted path.
UPLOAD_METADATA_PATHS = {
    "Description": "description",
    "Data updated at": "rowsUpdatedAt",
    "Data provided by": "tableAuthor.screenName",
}


def extract_paths(df: DataFrame, doc_col: str, paths: dict, id_col: str = "dataset_id",
                  zone: str | None = None) -> DataFrame:
    """``(id, name, raw, display)``: one row per (document, captured field).

    ``raw`` is the value at the dotted path (null when missing); ``display``
    renders epoch seconds as ``YYYY-MM-DD HH:MM`` for names ending in
    "updated at", and equals ``raw`` otherwise. One pass, no shuffle."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("name"), json_path(F.col(doc_col), path).alias("raw"))
        for name, path in paths.items()])
    long = df.select(F.col(id_col), F.inline(entries))
    is_time = F.lower(F.col("name")).endswith("updated at")
    display = F.when(is_time, epoch_text(F.col("raw").try_cast("bigint"), zone)).otherwise(F.col("raw"))
    return long.select(id_col, "name", "raw", display.alias("display"))


def write_metadata(df: DataFrame, path: str) -> None:
    """Store raw metadata documents as JSON lines (one file set per run)."""
    df.write.mode("overwrite").json(path)
