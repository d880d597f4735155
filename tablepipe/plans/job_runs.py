"""A pipeline run end to end over data derived from the driver tables.

``bike_trips_job``: every order becomes a trip exported the way the bike-share
dashboard exports it - one CSV row per (trip, measure), amounts with thousands
separators, station ids with leading zeros, US timestamps, the bike type only
on a later row of the trip - and the job reshapes, checks and appends it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.functions.timeops import us_datetime_text, utc_wall
from tablepipe.jobs import bike_trips, stop_times
from tablepipe.operators.sinks import delete_path, single_file
from tablepipe.plans._base import query, table
from tablepipe.session import scratch_path

_STATION = "lpad(CAST({c} AS VARCHAR), 6, '0')"


_BIKE_SQL = ("SELECT o_orderkey AS trip_id, o_orderstatus AS bike_type, o_orderdate AS end_datetime, "
       f"{_STATION.format(c='o_custkey % 997')} AS end_station, o_orderpriority AS end_station_name, "
       "'G' AS name_group, CAST(NULL AS VARCHAR) AS optional_kiosk_id_group, o_orderdate AS start_datetime, "
       f"{_STATION.format(c='o_custkey')} AS start_station, o_orderpriority AS start_station_name, "
       f"{_STATION.format(c='o_orderkey % 1000')} AS visible_id, o_totalprice AS distance, "
       "CAST(o_custkey AS DOUBLE) AS duration, "
       "CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS DOUBLE) / 4 END AS est_calories, "
       "CAST(NULL AS DOUBLE) AS est_carbon_offset FROM orders")


def _bike_export(spark, sf):
    """The dashboard export as a CSV path."""
    o = table(spark, sf, "orders")
    when = us_datetime_text("o_orderdate")
    station = lambda c: F.lpad(c.cast("string"), 6, "0")
    measures = F.array(
        F.struct(F.lit(0).alias("i"), F.lit("Distance").alias("m"), F.format_number("o_totalprice", 2).alias("v")),
        F.struct(F.lit(1).alias("i"), F.lit("Duration").alias("m"), F.col("o_custkey").cast("string").alias("v")),
        F.struct(F.lit(2).alias("i"), F.lit("Est Calories").alias("m"),
                 F.when(F.col("o_orderstatus") == "F", F.format_number(F.col("o_custkey") / 4, 2))
                 .alias("v")))
    rows = o.select("*", F.inline(measures)).where(F.col("v").isNotNull())
    export = rows.select(
        F.col("o_orderkey").alias("Trip ID"), when.alias("Start Datetime"), when.alias("End Datetime"),
        station(F.col("o_orderkey") % 1000).alias("Visible ID"),
        station(F.col("o_custkey")).alias("Start Station"),
        station(F.col("o_custkey") % 997).alias("End Station"),
        F.when(F.col("i") > 0, F.col("o_orderstatus")).alias("Bike Type"),
        F.col("o_orderpriority").alias("Start Station Name"), F.col("o_orderpriority").alias("End Station Name"),
        F.lit("G").alias("Name (group)"), F.lit(None).cast("string").alias("Optional Kiosk ID (group)"),
        F.col("m").alias("Measure Names"), F.col("v").alias("Measure Values"))
    csv = scratch_path(spark, "bike_export")
    export.write.option("header", True).csv(csv)
    return csv


@query("bike_trips_job", _BIKE_SQL)
def q_bike_trips_job(spark, sf):
    target = scratch_path(spark, "bike_trips")
    bike_trips.run(spark, _bike_export(spark, sf), target)
    return spark.read.parquet(target)


@query("bike_trips_migrate", _BIKE_SQL)
def q_bike_trips_migrate(spark, sf):
    """A new table loaded from the snapshot of the job's table."""
    target, snapshot, moved = (scratch_path(spark, f"bike_{x}") for x in ("trips", "snapshot", "moved"))
    bike_trips.run(spark, _bike_export(spark, sf), target, snapshot_path=snapshot)
    bike_trips.migrate(spark, snapshot, moved)
    return spark.read.parquet(moved)


_STOP_SQL = (
    "SELECT event_id % 40 AS arrival_passengers, ts AS arrive, value AS arrive_variance, "
    "'/blocks/' || user_id AS block_href, ts AS depart, -value AS depart_variance, "
    "event_id % 40 AS departure_passengers, '/drivers/' || user_id AS driver_href, event_id % 7 AS offs, "
    "event_id % 11 AS ons, '/patterns/' || event_type AS pattern_href, event_type AS pattern_name, "
    "'/routes/' || (user_id % 5) AS route_href, 'R' || (user_id % 5) AS route_name, "
    "'/runs/' || user_id AS run_href, CAST(user_id AS VARCHAR) AS run_name, ts AS scheduled_arrive, "
    "ts AS scheduled_depart, '/stops/' || event_type AS stop_href, event_type AS stop_name, "
    "user_id + 9007199254740991 AS trip_id, '/trips/' || user_id AS trip_href, 'T' || user_id AS trip_name, "
    "'/vehicles/' || (event_id % 9) AS vehicle_href, CAST(event_id % 9 AS VARCHAR) AS vehicle_name, "
    "DATE '2024-01-15' AS service_date FROM events "
    "WHERE NULLIF(user_id, 8) IS NOT NULL AND CAST(ts - INTERVAL 8 HOUR AS DATE) = DATE '2024-01-15'")


BIG_ID = 2**53 - 1  # trip ids around the last integer that a double holds exactly


def _stop_export(spark, sf):
    """Events exported as a day of stop times, one JSON array file: instants with a zone,
    numeric run and vehicle names, driver names, a null trip id, trip ids above 2^53, some
    stops exported twice with other counts."""
    ev = table(spark, sf, "events")
    iso = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    copy = F.explode(F.when(F.col("value") > 50, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = ev.select("*", copy.alias("copy"))
    uid = F.col("user_id").cast("string")
    export = rows.select(
        (F.col("event_id") % 40).alias("arrival_passengers"), iso.alias("arrive"),
        F.col("value").alias("arrive_variance"), F.concat(F.lit("/blocks/"), uid).alias("block_href"),
        iso.alias("depart"), (-F.col("value")).alias("depart_variance"),
        (F.col("event_id") % 40 + F.col("copy") * 100).alias("departure_passengers"),
        F.concat(F.lit("/drivers/"), uid).alias("driver_href"), (F.col("event_id") % 7).alias("offs"),
        (F.col("event_id") % 11 + F.col("copy") * 1000).alias("ons"),
        F.concat(F.lit("/patterns/"), F.col("event_type")).alias("pattern_href"),
        F.col("event_type").alias("pattern_name"),
        F.concat(F.lit("/routes/"), (F.col("user_id") % 5).cast("string")).alias("route_href"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("route_name"),
        F.concat(F.lit("/runs/"), uid).alias("run_href"), F.col("user_id").alias("run_name"),
        iso.alias("scheduled_arrive"), iso.alias("scheduled_depart"),
        F.concat(F.lit("/stops/"), F.col("event_type")).alias("stop_href"), F.col("event_type").alias("stop_name"),
        (F.nullif(F.col("user_id"), F.lit(8)) + F.lit(BIG_ID)).alias("trip_id"),
        F.concat(F.lit("/trips/"), uid).alias("trip_href"), F.concat(F.lit("T"), uid).alias("trip_name"),
        F.concat(F.lit("/vehicles/"), (F.col("event_id") % 9).cast("string")).alias("vehicle_href"),
        (F.col("event_id") % 9).alias("vehicle_name"),
        F.lit("Ann").alias("driver_first_name"), F.lit("Lee").alias("driver_last_name"))
    path = scratch_path(spark, "stop_times_export") + ".json"
    lines = export.select(F.concat(F.lit(","), F.to_json(F.struct(*export.columns))).alias("value"))
    single_file(lines.write.format("text"), spark, path, head="[", tail="]", skip=1)
    return path


@query("stop_times_job", _STOP_SQL)
def q_stop_times_job(spark, sf):
    """The export loaded twice by the job into a table partitioned by day (the second load adds
    nothing) and snapshotted for 2024-01-15 at UTC-8. Time columns come back as UTC wall clocks."""
    path = _stop_export(spark, sf)
    target, snap = scratch_path(spark, "stop_times"), scratch_path(spark, "stop_times_days")
    for _ in range(2):
        stop_times.run(spark, path, target, "2024-01-15", snapshot_root=snap)
    return _walls(spark.read.parquet(snap))


def _walls(rows):
    return rows.withColumns({c: utc_wall(c) for c in stop_times.TIME_COLUMNS})


@query("stop_times_migrate", _STOP_SQL.replace("DATE '2024-01-15' AS service_date", "CAST(ts - INTERVAL 8 HOUR AS DATE) AS arrive_day")
       .replace(" AND CAST(ts - INTERVAL 8 HOUR AS DATE) = DATE '2024-01-15'", ""))
def q_stop_times_migrate(spark, sf):
    """A partitioned table reloaded from the parquet rows of another, with every row there twice.
    Each table in scratch goes when the next one is complete."""
    target, moved = scratch_path(spark, "stop_times"), scratch_path(spark, "stop_times_moved")
    stop_times.load(spark, _stop_export(spark, sf), target, keep_export=False)
    rows = spark.read.parquet(target)
    rows.unionByName(rows).write.parquet(f"{moved}-source")
    delete_path(spark, target)
    stop_times.migrate(spark, f"{moved}-source", moved)
    delete_path(spark, f"{moved}-source")
    return _walls(spark.read.parquet(moved))


_RIDERSHIP_SQL = ("SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(month(o_orderdate) AS VARCHAR) AS month, "
       "o_orderpriority AS line, o_orderstatus AS \"Day Type\", count(*) AS \"Orders\", "
       "max(o_custkey) AS \"Top Customer\" FROM orders GROUP BY ALL")


@query("ridership_job", _RIDERSHIP_SQL)
def q_ridership_job(spark, sf):
    """The table of all result pages."""
    from tablepipe.jobs import ridership

    return ridership.parse_pages(_ridership_pages(spark, sf))[0]


@query("ridership_snapshot", " UNION ALL ".join(
    f"SELECT *, DATE '{day}' AS snapshot_date FROM ({_RIDERSHIP_SQL}) WHERE {cond}"
    for day, cond in (("2024-03-01", "year < '1996'"), ("2024-03-02", "true"))))
def q_ridership_snapshot(spark, sf):
    """The job run on two days, the second with more pages: the table is replaced, each day's
    snapshot stays. A re-run of the second day replaces its snapshot."""
    import datetime as dt

    from tablepipe.jobs import ridership
    from tablepipe.plans.writes import _scratch_table

    pages = _ridership_pages(spark, sf)
    name, root = _scratch_table(spark, "ridership"), scratch_path(spark, "ridership_days")
    for day, part in ((1, pages.where("year < '1996'")), (2, pages), (2, pages)):
        ridership.run(spark, part, name, snapshot_root=root, run_date=dt.date(2024, 3, day))
    return spark.read.option("recursiveFileLookup", "false").parquet(root).withColumn("year", F.col("year").cast("string"))


def _ridership_pages(spark, sf):
    """Result pages rendered from orders - one per (year, month, priority as
    line), a row per order status with counts in thousands format and a Total
    row - parsed back by the ridership job (Total removed, numbers typed)."""
    from tablepipe.jobs import ridership

    o = table(spark, sf, "orders")
    keys = [F.year("o_orderdate").cast("string").alias("year"), F.month("o_orderdate").cast("string").alias("month"),
            F.col("o_orderpriority").alias("line")]
    per_type = o.groupBy(*keys, F.col("o_orderstatus").alias("day_type")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_custkey").alias("top"))
    row = F.format_string("<tr><td>%s</td><td>%s</td><td>%s</td></tr>", F.col("day_type"),
                          F.format_number("n", 0), F.col("top").cast("string"))
    # a page holds one row per order status (a handful), so collecting them is bounded
    pages = per_type.groupBy("year", "month", "line").agg(
        F.concat_ws("", F.collect_list(row)).alias("body"), F.sum("n").alias("total"))
    html = F.concat(
        F.lit(f'<html><body><table id="{ridership.TABLE_ID}"><tr><th>Day Type</th><th>Orders</th>'
              "<th>Top Customer</th></tr>"),
        F.col("body"), F.lit("<tr><td>Total</td><td>"), F.format_number("total", 0),
        F.lit("</td><td></td></tr></table></body></html>"))
    return pages.select("year", "month", "line", html.alias("html"))


@query("requests_311_job",
       "SELECT o_orderkey, o_orderdate AS createddate, o_orderpriority AS requesttype, o_totalprice FROM orders "
       "WHERE o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 6 MONTH AND o_orderpriority <> '5-LOW'")
def q_requests_311_job(spark, sf):
    """Orders as service requests: the last six months without one category,
    published as a single CSV file and read back."""
    import datetime as dt

    from tablepipe.jobs import requests_311

    src = scratch_path(spark, "requests_src")
    table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("createddate"), F.col("o_orderpriority").alias("requesttype"),
        "o_totalprice").write.parquet(src)
    out = scratch_path(spark, "requests") + ".csv"
    requests_311.run(spark, src, out, as_of=dt.datetime(2001, 8, 1), excluded="5-LOW")
    return (spark.read.schema("o_orderkey bigint, createddate timestamp_ntz, requesttype string, o_totalprice double")
            .option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(out))


_PORTAL_DOC = {
    "description": "Customers of the fixture; it's published page by page",
    "columns": [
        {"name": "c_custkey", "dataTypeName": "number"},
        {"name": "c_name", "dataTypeName": "text"},
        {"name": "c_nationkey", "dataTypeName": "number"},
        {"name": "c_acctbal", "dataTypeName": "money"},
        {"name": "c_mktsegment", "dataTypeName": "text"},
        {"name": "Location Point", "dataTypeName": "point"},
        {"name": "Retired Flag", "dataTypeName": "checkbox"},
    ],
}


_PORTAL_SQL = ("SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey, "
       "c_acctbal, c_mktsegment, '(' || c_custkey || ', ' || c_nationkey || ')' AS locationpoint, "
       "'row-' || c_custkey AS id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS created_at, "
       "TIMESTAMP '2024-06-01 00:00:00' + to_seconds(c_custkey) AS updated_at FROM customer")


def _portal(spark, sf):
    """Customers published as a portal dataset: key order, system columns, a point column."""
    from tablepipe.functions.timeops import ntz_literal
    from tablepipe.sources.paged import build_page_index

    c = table(spark, sf, "customer")
    published = c.orderBy("c_custkey").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.format_string("POINT (%d %d)", "c_custkey", "c_nationkey").alias("Location Point"),
        F.concat(F.lit("row-"), F.col("c_custkey").cast("string")).alias(":id"),
        F.timestamp_add("SECOND", F.col("c_custkey"), ntz_literal("2024-01-01 00:00:00")).alias(":created_at"),
        F.timestamp_add("SECOND", F.col("c_custkey"), ntz_literal("2024-06-01 00:00:00")).alias(":updated_at"))
    store, index = scratch_path(spark, "portal_customer"), scratch_path(spark, "portal_index")
    published.write.parquet(store)
    build_page_index(spark, store, index)
    return {"path": store, "index_path": index}


@query("portal_import_job", _PORTAL_SQL)
def q_portal_import_job(spark, sf):
    """The dataset imported by the portal job: schema from the metadata (a drifted column
    removed, system fields merged), pages read in parallel, points rewritten, columns typed,
    table loaded and commented."""
    import json

    from tablepipe.jobs import portal_import
    from tablepipe.plans.writes import _scratch_table

    name = _scratch_table(spark, "portal_customer")
    portal_import.run(spark, "cust-0001", "tablepipe.sources.paged:SortedParquetFetcher", _portal(spark, sf),
                      json.dumps(_PORTAL_DOC), table=name, warehouse="postgres", page_size=1000)
    return spark.table(name)


@query("portal_import_files", """
SELECT 'extract' AS kind, count(*) || ' rows, ids ' || sum(c_custkey) AS value FROM customer
UNION ALL SELECT 'Description', 'Customers: ' || count(*) FROM customer
UNION ALL SELECT 'Data updated at', strftime(make_timestamp(max(c_custkey) * 1000000), '%Y-%m-%d %H:%M') FROM customer
UNION ALL SELECT 'Data provided by', NULL FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'document', 'Customers: ' || count(*) || ', ' || max(c_custkey) || ', 7 columns' FROM customer""")
def q_portal_import_files(spark, sf):
    """The files of the import: the dated extract (one CSV), the captured metadata fields and the
    raw document. Description and time of the document come from the table."""
    import json

    from tablepipe.jobs import portal_import

    n, last = table(spark, sf, "customer").agg(F.count("*"), F.max("c_custkey")).first()
    doc = json.dumps({**_PORTAL_DOC, "description": f"Customers: {n}", "rowsUpdatedAt": last})
    root = scratch_path(spark, "portal_files")
    portal_import.run(spark, "cust-0001", "tablepipe.sources.paged:SortedParquetFetcher", _portal(spark, sf), doc,
                      page_size=1000, metadata_path=f"{root}/meta", extract_root=root)
    extract = spark.read.option("header", True).csv(f"{root}/{portal_import.dated_name('cust-0001', 'extract')}")
    ids = F.sum(F.col("c_custkey").cast("double")).cast("bigint").cast("string")
    total = extract.agg(F.concat(F.count("*").cast("string"), F.lit(" rows, ids "), ids).alias("value"))
    fields = spark.read.parquet(f"{root}/meta/fields").select(F.col("name").alias("kind"), F.col("display").alias("value"))
    raw = spark.read.text(f"{root}/meta/{portal_import.dated_name('cust-0001', 'metadata')}")
    at = lambda path: F.get_json_object("value", path)
    columns = F.size(F.from_json(at("$.columns"), "array<string>")).cast("string")
    raw = raw.select(F.lit("document").alias("kind"), F.concat(at("$.description"), F.lit(", "), at("$.rowsUpdatedAt"), F.lit(", "),
                                                               columns, F.lit(" columns")).alias("value"))
    return total.select(F.lit("extract").alias("kind"), "value").unionByName(fields).unionByName(raw)
