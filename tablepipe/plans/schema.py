"""Contract and metadata-driven schema queries.

The schema queries start from JSON rows: one dataset per part brand and one per event
type. Which columns a dataset has, and of which portal type, is found from all of its
rows; the documents, drift and table schemas follow from that.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.operators.contract import (
    TableContract,
    contract_report,
    map_types,
    merge_system_fields,
    metadata_columns,
    schema_drift,
)
from tablepipe.operators.infer import data_headers, fields, metadata_documents
from tablepipe.plans._base import query, table


def _json_rows(spark, sf):
    """(dataset_id, row_id, doc): parts and events as JSON rows. Brands differ in the geometry
    of their place; some values change type from row to row."""
    p = table(spark, sf, "part")
    brand = F.substring("p_brand", 7, 9).cast("int")
    text = lambda c: F.col(c).cast("string")
    key = lambda name, value: F.concat(F.lit(f'"{name}":'), value)
    shape = F.element_at(F.array(*[F.lit(g) for g in ("Point", "MultiPoint", "MultiLineString", "Polygon", "MultiPolygon")]), brand % 5 + 1)
    half = F.col("p_size") % 3 == 0
    doc = F.concat(F.lit("{"), F.concat_ws(
        ",", key("Part Key", text("p_partkey")),
        F.concat(F.lit('"'), F.col("p_type"), F.lit(' Price":'), text("p_retailprice")),
        key("List Price", F.concat(F.lit('"$'), F.format_number("p_retailprice", 2), F.lit('"'))),
        key("In Stock", (F.col("p_size") > 25).cast("string")),
        key("Released", F.concat(F.lit('"2024-01-'), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), F.lit('T00:00:00.000"'))),
        key("Place", F.concat(F.lit('{"type":"'), shape, F.lit('","coordinates":[]}'))),
        key("Site", F.lit('{"latitude":"34.05","longitude":"-118.24"}')),
        key("Size", F.when(F.col("p_size") > 40, F.lit('"large"')).otherwise(text("p_size"))),
        key("Weight", F.when(half, text("p_size")).otherwise(F.concat(text("p_size"), F.lit(".5")))),
        F.lit('"Note":null'),
        F.when(brand % 2 == 1, key("created_at", F.concat(F.lit('"'), F.col("p_name"), F.lit('"')))),
        F.when(F.col("p_partkey") % 4 == 0, key("sid", F.concat(F.lit('"row-'), text("p_partkey"), F.lit('"'))))), F.lit("}"))
    parts = p.select(F.col("p_brand").alias("dataset_id"), F.col("p_partkey").alias("row_id"), doc.alias("doc"))
    events = table(spark, sf, "events").select(F.col("event_type").alias("dataset_id"), F.col("event_id").alias("row_id"), F.col("props").alias("doc"))
    return parts.unionByName(events)


def _column_sql(spot, name, kind, where="true", by=""):
    return (f"SELECT p_brand AS dataset_id, {spot} AS spot, {name} AS raw_name, {kind} AS data_type, "
            f"bool_or(p_partkey % 2 = 0) AS loaded FROM p WHERE {where} GROUP BY p_brand, b{by}")


_COLUMNS_SQL = ("WITH p AS (SELECT *, CAST(substr(p_brand, 7) AS INTEGER) AS b FROM part), c AS ("
                + " UNION ALL ".join([
                    _column_sql(0, "'Part Key'", "'number'"), _column_sql(1, "p_type || ' Price'", "CASE WHEN bool_and(p_retailprice = floor(p_retailprice)) THEN 'number' ELSE 'double' END", by=", p_type"),
                    _column_sql(2, "'List Price'", "'money'"), _column_sql(3, "'In Stock'", "'checkbox'"),
                    _column_sql(4, "'Released'", "'calendar_date'"),
                    _column_sql(5, "'Place'", "['point', 'multipoint', 'multiline', 'polygon', 'multipolygon'][b % 5 + 1]"),
                    _column_sql(6, "'Site'", "'location'"), _column_sql(7, "'Size'", "CASE WHEN max(p_size) > 40 THEN 'text' ELSE 'number' END"),
                    _column_sql(8, "'Weight'", "CASE WHEN bool_and(p_size % 3 = 0) THEN 'number' ELSE 'double' END"),
                    _column_sql(9, "'Note'", "'text'"), _column_sql(10, "'created_at'", "'text'", "b % 2 = 1"),
                    _column_sql("10 + b % 2", "'sid'", "'text'", "p_partkey % 4 = 0"),
                    "SELECT event_type, 0, 'k', 'number', bool_or(event_id % 2 = 0) FROM events GROUP BY event_type"])
                + "), m AS (SELECT dataset_id, CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY spot, raw_name) - 1 AS INTEGER) "
                "AS position, raw_name, regexp_replace(lower(trim(raw_name)), '[^a-z0-9_]', '', 'g') AS name, data_type, "
                "loaded AND raw_name <> 'sid' AS kept FROM c) ")


def _type_sql(point):
    return ("CASE WHEN data_type IN ('number', 'double', 'money') THEN 'DOUBLE PRECISION' WHEN data_type = 'checkbox' THEN 'boolean' "
            f"WHEN data_type = 'calendar_date' THEN 'TIMESTAMP' WHEN data_type = 'point' THEN '{point}' ELSE 'VARCHAR(1024)' END")


def _metadata(spark, sf):
    rows = _json_rows(spark, sf)
    return metadata_columns(metadata_documents(fields(rows, "doc", "dataset_id"), "dataset_id"))


def _headers(spark, sf):
    """What the data has by now: the headers of the even rows."""
    rows = _json_rows(spark, sf).where(F.col("row_id") % 2 == 0)
    return data_headers(fields(rows, "doc", "dataset_id"), "dataset_id")


@query("metadata_columns", _COLUMNS_SQL + "SELECT dataset_id, position, raw_name, name, data_type FROM m")
def q_metadata_columns(spark, sf):
    """Metadata documents built from all JSON rows of each dataset, read back as columns."""
    return _metadata(spark, sf)


@query("type_map_lookup", _COLUMNS_SQL + " UNION ALL ".join(
    f"SELECT dataset_id, name, data_type, '{kind}' AS warehouse, {_type_sql(point)} AS sql_type, "
    f"{'data_type = ' + repr('point') if point == 'POINT' else 'false'} AS is_point FROM m"
    for kind, point in (("redshift", "VARCHAR(1024)"), ("postgres", "POINT"))))
def q_type_map_lookup(spark, sf):
    """The table types of every dataset's columns, for both kinds of warehouse."""
    meta = _metadata(spark, sf)
    both = [map_types(meta, kind).withColumn("warehouse", F.lit(kind)) for kind in ("redshift", "postgres")]
    return both[0].unionByName(both[1]).select("dataset_id", "name", "data_type", "warehouse", "sql_type", "is_point")


@query("schema_drift", _COLUMNS_SQL + "SELECT dataset_id, name FROM m WHERE NOT kept")
def q_schema_drift(spark, sf):
    """Columns that the metadata names and the data no longer has; the row id is there under its table name."""
    return schema_drift(_metadata(spark, sf), _headers(spark, sf)).select("dataset_id", "name")


@query("schema_merge", _COLUMNS_SQL + f""", s AS (
  SELECT dataset_id, name, position, {_type_sql('POINT')} AS sql_type, 0 AS rank FROM m WHERE kept
  UNION ALL SELECT dataset_id, f.name, 1000 + f.rank, f.sql_type, f.rank FROM (SELECT DISTINCT dataset_id FROM m),
    (VALUES ('id', 'VARCHAR(2048)', 1), ('created_at', 'TIMESTAMP', 2), ('updated_at', 'TIMESTAMP', 3)) AS f(name, sql_type, rank)),
u AS (SELECT dataset_id, name, arg_max(sql_type, rank) AS sql_type, min(position) AS spot FROM s GROUP BY ALL)
SELECT dataset_id, CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY spot) - 1 AS INTEGER) AS position, name, sql_type FROM u""")
def q_schema_merge(spark, sf):
    """Schema per dataset: drifted columns removed, types mapped, system fields merged (a data
    column with a system name keeps its place and takes the system type)."""
    meta = _metadata(spark, sf)
    kept = meta.join(_headers(spark, sf), on=["dataset_id", "name"], how="left_semi")
    typed = map_types(kept, "postgres").select("dataset_id", "position", "name", "sql_type")
    return merge_system_fields(typed, datasets=meta)


ORDERS_DECLARED_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                        ("o_totalprice", "double"), ("o_orderdate", "timestamp"),
                        ("o_orderpriority", "string"), ("o_shippriority", "int")]
ORDERS_DECLARED = TableContract.from_ddl(", ".join(f"{c} {t}" for c, t in ORDERS_DECLARED_COLS),
                                         name="orders")


def _report_sql() -> str:
    actual = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
              "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
    parts = []
    for name, exp in ORDERS_DECLARED_COLS:
        act = actual.get(name)
        if act is None:
            parts.append(f"SELECT '{name}' AS column_name, '{exp}' AS expected, CAST(NULL AS VARCHAR) "
                         "AS actual, CAST(NULL AS BIGINT) AS nulls, FALSE AS ok")
            continue
        nulls = f"(SELECT count(*) - count({name}) FROM orders)"
        ok = "TRUE" if act == exp else "FALSE"
        if exp in ("bigint", "int"):
            ok = f"({ok} AND {nulls} = 0)"
        parts.append(f"SELECT '{name}' AS column_name, '{exp}' AS expected, '{act}' AS actual, "
                     f"CAST({nulls} AS BIGINT) AS nulls, {ok} AS ok")
    return " UNION ALL ".join(parts)


@query("contract_report", _report_sql())
def q_contract_report(spark, sf):
    return contract_report(table(spark, sf, "orders"), ORDERS_DECLARED)
