"""Paged extract and GeoJSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.plans._base import ORDERS_COLS, query, table
from tablepipe.session import scratch_path
from tablepipe.operators.sinks import replace_table, single_file
from tablepipe.sources.manifest import load_datasets, read_geojson, write_geojson_collection, write_geojson_seq
from tablepipe.sources.paged import build_page_index, read_paged
from tablepipe.sources.typed import read_typed_json

FETCHER = "tablepipe.sources.paged:SortedParquetFetcher"


COUNTLESS = "tablepipe.sources.paged:CountlessFetcher"


def _paged_orders(spark, sf, page_size, size_limit=None, fetcher=FETCHER):
    """Orders published in key order, then extracted page by page; the pages
    arrive as text and are typed back by one projection."""
    orders = table(spark, sf, "orders")
    store, index = scratch_path(spark, "portal_orders"), scratch_path(spark, "portal_index")
    orders.orderBy("o_orderkey").write.parquet(store)
    build_page_index(spark, store, index)
    raw = read_paged(spark, fetcher, ORDERS_COLS, page_size=page_size, size_limit=size_limit,
                     fetcher_args={"path": store, "index_path": index})
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema.fields])


@query("paged_scan", "SELECT * FROM orders")
def q_paged_scan(spark, sf):
    return _paged_orders(spark, sf, 4000)


@query("paged_scan_countless", "SELECT * FROM orders")
def q_paged_scan_countless(spark, sf):
    """The whole extract from a source without a row count: its last page is searched, then
    every page is a task."""
    return _paged_orders(spark, sf, 700, fetcher=COUNTLESS)


@query("paged_scan_limited", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 4000")
def q_paged_scan_limited(spark, sf):
    # P = 1,000 and S = 2,500: pages at 0, 1000, 2000, 3000 (the last starts past S)
    return _paged_orders(spark, sf, 1000, size_limit=2500)


@query("geojson_features",
       "SELECT c_custkey, c_name, '{\"type\":\"Point\",\"coordinates\":[' || c_custkey || ',' || "
       "c_nationkey || ']}' AS geometry, 'Point' AS geometry_type FROM customer")
def q_geojson_features(spark, sf):
    c = table(spark, sf, "customer")
    geom = F.to_json(F.struct(F.lit("Point").alias("type"),
                              F.array(F.col("c_custkey"), F.col("c_nationkey").cast("bigint"))
                              .alias("coordinates")))
    path = scratch_path(spark, "customers_geojson")
    write_geojson_seq(c.select("c_custkey", "c_name", geom.alias("geometry")), path)
    return read_geojson(spark, path, properties_schema="c_custkey bigint, c_name string", kind="seq")


def _geometry(x, y):
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates")))


@query("geojson_collection",
       "SELECT l_orderkey, l_linenumber, l_extendedprice, '{\"type\":\"Point\",\"coordinates\":[' || l_partkey || ',' || l_suppkey "
       "|| ']}' AS geometry, 'Point' AS geometry_type FROM lineitem")
def q_geojson_collection(spark, sf):
    """One FeatureCollection file, read by byte ranges; the property types are found from all features."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "lineitem") + ".geojson"
    write_geojson_collection(li.select("l_orderkey", "l_linenumber", "l_extendedprice", _geometry("l_partkey", "l_suppkey").alias("geometry")), path)
    return read_geojson(spark, path)


def _array_file(spark, lines, name):
    """One file with a JSON array of the objects in ``lines`` (JSON text)."""
    path = scratch_path(spark, name) + ".json"
    rows = lines.select(F.concat(F.lit(","), lines.columns[0]).alias("value"))
    single_file(rows.write.format("text"), spark, path, head="[", tail="]\n", skip=1)
    return path


@query("json_array_rejects", """
SELECT CASE WHEN event_id % 13 = 0 THEN 'rejected' ELSE event_type END AS kind, count(*) AS n,
  sum(CASE WHEN event_id % 13 = 0 THEN 0 ELSE event_id END) AS ids FROM events GROUP BY ALL""")
def q_json_array_rejects(spark, sf):
    """Events as one JSON array file in which every 13th value is no number: the records that
    fit are typed, the others kept as rejects. Texts hold brackets, quotes and backslashes."""
    note = F.concat(F.lit('}],{["\\ '), F.col("props"))
    value = F.when(F.col("event_id") % 13 == 0, F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    fixed = F.to_json(F.struct("event_id", "event_type", note.alias("note")))
    line = F.concat(F.substring(fixed, 1, F.length(fixed) - 1), F.lit(',"value":'), value, F.lit("}"))
    path = _array_file(spark, table(spark, sf, "events").select(line.alias("line")), "events_array")
    rows = read_typed_json(spark, path, "event_id bigint, event_type string, value double, note string, _corrupt_record string",
                           mode="PERMISSIVE")
    bad = F.col("_corrupt_record").isNotNull()
    return rows.groupBy(F.when(bad, "rejected").otherwise(F.col("event_type")).alias("kind")).agg(
        F.count("*").alias("n"), F.sum(F.when(bad, 0).otherwise(F.col("event_id"))).alias("ids"))


@query("manifest_load", """
SELECT 'customers' AS table_name, 'geojson' AS format, true AS ok, count(*) AS rows FROM customer
UNION ALL SELECT 'nations', 'csv', false, count(*) FROM nation
UNION ALL SELECT 'parts', 'geojson', false, NULL FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'shapes', NULL, false, NULL FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'suppliers', 'csv', true, count(*) FROM supplier""")
def q_manifest_load(spark, sf):
    """A manifest of five datasets loaded side by side: one as a feature collection though a CSV is
    offered too, one as CSV, one whose reload fails and keeps its rows, one cut off before its
    end, one in a format that nobody reads."""
    base = scratch_path(spark, "manifest")
    c = table(spark, sf, "customer")
    write_geojson_collection(c.select("c_custkey", "c_name", _geometry("c_custkey", "c_nationkey").alias("geometry")), f"{base}/customers.geojson")
    table(spark, sf, "supplier").write.option("header", True).csv(f"{base}/suppliers")
    part = table(spark, sf, "part").select(F.format_string('{"type":"Feature","properties":{"k":%d},"geometry":null}', "p_partkey").alias("value"))
    single_file(part.select(F.concat(F.lit(","), "value").alias("value")).write.format("text"), spark, f"{base}/parts.geojson",
                head='{"type":"FeatureCollection","features":[', tail="", skip=1)  # cut off
    db = "tablepipe_manifest_" + base.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/tables'")
    replace_table(table(spark, sf, "nation"), f"{db}.nations")
    offers = [("customers", "csv", f"{base}/none"), ("customers", "geojson", f"{base}/customers.geojson"), ("suppliers", "csv", f"{base}/suppliers"),
              ("nations", "csv", f"{base}/missing"), ("parts", "geojson", f"{base}/parts.geojson"), ("shapes", "shapefile", f"{base}/s.zip")]
    manifest = spark.createDataFrame([(t, None, f, u) for t, f, u in offers], "table_name string, item_id string, format string, url string")
    results = load_datasets(spark, manifest, db)
    counts = None
    for name in ("customers", "suppliers", "nations"):
        one = spark.table(f"{db}.{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return results.join(counts, "table_name", "left").select("table_name", "format", "ok", "rows")
