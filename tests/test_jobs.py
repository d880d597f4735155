"""The pipelines end to end on small file fixtures (FIXTURES.md)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tablepipe.jobs import bike_trips, catalog_report, geo_datasets, portal_import, requests_311, ridership, stop_times
from tablepipe.streaming.incremental import batch_writer, ingest_available, read_ingested

HEADER = ("Trip ID,Start Datetime,End Datetime,Visible ID,Start Station,End Station,Bike Type,"
          "Start Station Name,End Station Name,Name (group),Optional Kiosk ID (group),Measure Names,Measure Values\n")


def _trip_rows(trip, measures, bike="standard"):
    return "".join(f'{trip},2024-01-01 08:00:00,2024-01-01 08:30:00,007,03005,03006,{bike},A,B,G,K,{m},"{v}"\n'
                   for m, v in measures)


def test_bike_trips_job(spark, out):
    p = f"{out}/trips.csv"
    with open(p, "w") as f:
        f.write(HEADER + _trip_rows(1, [("Distance", "1,234.5"), ("Duration", "30"), ("Est Calories", "12"),
                                        ("Est Carbon Offset", "0.5")])
                + _trip_rows(2, [("Distance", "2")]) + _trip_rows("", [("Distance", "9")]))
    target = f"{out}/bike_trips"
    bike_trips.run(spark, p, target, snapshot_path=f"{out}/snap")
    bike_trips.run(spark, p, target)  # idempotent
    got = {r.trip_id: r for r in spark.read.parquet(target).collect()}
    assert set(got) == {1, 2}
    assert got[1].distance == 1234.5 and got[2].duration is None
    assert spark.read.parquet(target).columns == bike_trips.BIKE_TRIPS.names
    bike_trips.migrate(spark, f"{out}/snap", f"{out}/reloaded")
    assert spark.read.parquet(f"{out}/reloaded").count() == 2


def test_bike_trips_duplicate_measure(spark, out):
    p = f"{out}/dup.csv"
    with open(p, "w") as f:
        f.write(HEADER + _trip_rows(1, [("Distance", "1"), ("Distance", "2")]))
    with pytest.raises(Exception, match="duplicate"):
        bike_trips.run(spark, p, f"{out}/t")


def _stop(trip, stop, arrive, **kw):
    row = {c: None for c in stop_times.STOP_TIMES.names}
    row.update({"trip_id": trip, "stop_name": stop, "scheduled_arrive": arrive, "scheduled_depart": arrive,
                "arrive": arrive, "depart": arrive, "run_name": 12, "ons": 1, "offs": 0,
                "arrival_passengers": 3, "departure_passengers": 4, "driver_first_name": "x",
                "driver_last_name": "y"})
    row.update(kw)
    return row


def test_stop_times_job(spark, out):
    rows = [_stop(1.0, "Main", "2024-07-01T07:30:00Z"), _stop(1.0, "Main", "2024-07-01T07:30:00Z", ons=99),
            _stop(None, "Main", "2024-07-01T08:00:00Z"), _stop(2.0, "Oak", None), _stop(2.0, "Oak", None),
            _stop(3.0, "Elm", "2024-07-01T07:45:00Z")]
    p = f"{out}/day.json"
    with open(p, "w") as f:
        json.dump(rows, f)
    target = f"{out}/stops"
    stop_times.run(spark, p, target, day="2024-06-30", snapshot_root=f"{out}/days")
    t = spark.read.parquet(target)
    assert t.count() == 4  # null trip dropped, repeated key once, null scheduled_arrive twice
    assert t.where("trip_id = 1").first().ons == 1  # first row of the batch wins
    assert t.where("trip_id = 1").first().run_name == "12"
    # a later load reads only the days it has
    later = spark.createDataFrame([(dt.date(2024, 7, 9),)], "arrive_day date").crossJoin(t.drop("arrive_day").limit(1))
    from tablepipe.operators.sinks import plan_append

    plan = plan_append(later, target, stop_times.STOP_TIMES.keys, "ons", partition_col="arrive_day")
    scans = plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]
    assert any("2024-07-09" in x.split("PushedFilters")[0] for x in scans)
    snap = spark.read.parquet(f"{out}/days")
    assert snap.select("service_date").distinct().collect()[0][0] == dt.date(2024, 6, 30)
    assert snap.count() == 2  # 07:30Z and 07:45Z are June 30 at UTC-8
    stop_times.run(spark, p, target, day="2024-06-30")
    assert spark.read.parquet(target).count() == 6  # only the null-key rows insert again


def test_stop_times_null_integer_fails(spark, out):
    p = f"{out}/bad.json"
    with open(p, "w") as f:
        json.dump([_stop(1.0, "Main", "2024-07-01T07:30:00Z", ons=None)], f)
    with pytest.raises(Exception, match="null in integer column"):
        stop_times.run(spark, p, f"{out}/t", day="2024-06-30")
    import glob

    assert not glob.glob(f"{out}/t/*.parquet")  # the failed load committed nothing


def test_stop_times_empty_export(spark, out):
    p = f"{out}/empty.json"
    with open(p, "w") as f:
        f.write("[]")
    assert stop_times.run(spark, p, f"{out}/t", day="2024-06-30") is False


FORM = """<select id="ContentPlaceHolder1_ddlYear"><option value="2023">2023</option>
<option value="2024">2024</option></select><select id="ContentPlaceHolder1_lbLines">
<option value="All">All</option><option value="801">801</option></select>"""


def _result(extra=False):
    head = "<tr><th>Day Type</th><th>Avg</th>" + ("<th>Extra</th>" if extra else "") + "</tr>"
    cell = "<td>1,234</td>" + ("<td>e</td>" if extra else "")
    return (f'<table id="{ridership.TABLE_ID}">{head}<tr><td>Weekday</td>{cell}</tr>'
            f"<tr><td></td>{cell}</tr><tr><td>Total</td>{cell}</tr></table>")


def test_ridership_job(spark, out):
    form = spark.createDataFrame([(FORM,)], "html string")
    wl = ridership.worklist(spark, form, as_of=dt.date(2024, 3, 10))
    assert wl.count() == 14
    pages = spark.createDataFrame([
        ("2023", "1", "801", _result()), ("2023", "2", "801", _result(extra=True)),
        ("2023", "3", "801", "Data not available yet"), ("2023", "4", "801", "<p>no table</p>")],
        "year string, month string, line string, html string")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS transport_test LOCATION '{out}/wh'")
    rejects = ridership.run(spark, pages, "transport_test.ridership", snapshot_root=f"{out}/snap",
                            run_date=dt.date(2024, 3, 10))
    t = spark.table("transport_test.ridership")
    assert t.count() == 4  # Total rows removed, blank day type kept
    assert t.where("`Day Type` IS NULL").count() == 2  # blank cells are null, and kept
    assert dict(t.dtypes)["Avg"] == "bigint" and t.first()["Avg"] == 1234
    assert "Extra" in t.columns and t.where("Extra IS NOT NULL").count() == 2
    assert sorted(r.month for r in rejects.collect()) == ["3", "4"]
    assert spark.read.parquet(f"{out}/snap").select("snapshot_date").first()[0] == dt.date(2024, 3, 10)


def test_requests_311(spark, out):
    df = spark.createDataFrame([
        ("2024-08-01 00:00:00", "Graffiti"), ("2024-01-01 00:00:00", "Graffiti"),
        ("2024-08-01 00:00:00", "Homeless Encampment"), ("2024-08-01 00:00:00", None)],
        "createddate string, requesttype string").withColumn("createddate", F.col("createddate").cast("timestamp_ntz"))
    df.write.parquet(f"{out}/src")
    requests_311.run(spark, f"{out}/src", f"{out}/csv", as_of=dt.datetime(2024, 8, 31))
    back = spark.read.option("header", True).csv(f"{out}/csv")
    assert [r.requesttype for r in back.collect()] == ["Graffiti"]


def test_bike_trips_refuse_what_they_cannot_read(spark, out):
    head = "Trip ID,Measure Names,Measure Values,Start Datetime,End Datetime,Visible ID,Start Station,End Station\n"
    good = '9007199254740993,Distance,"1,000.5",1/2/2024 3:04,1/2/2024 3:05,01,02,03\n'
    near = '9007199254740992,Duration,7,1/2/2024 3:04,1/2/2024 3:05,01,02,03\n'
    for name, line, message in (("id", "X9,Distance,1,,,,,\n", "Trip ID"), ("value", "5,Distance,bad,,,,,\n", "Distance"),
                                ("time", "5,Distance,1,nonsense,,,,\n", "Start Datetime"), ("measure", "5,Elevation,1,,,,,\n", "Elevation"),
                                (None, "", None)):
        path = f"{out}/{name}.csv"
        with open(path, "w") as f:
            f.write(head + good + near + line)
        rows = bike_trips.reshape(bike_trips.read_trips(spark, path))
        if message:
            with pytest.raises(Exception, match=message):
                rows.collect()
        else:
            assert {(r.trip_id, r.distance, r.duration) for r in rows.collect()} == {
                (9007199254740993, 1000.5, None), (9007199254740992, None, 7.0)}


def test_geo_datasets(spark, out):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}
    with open(f"{out}/b.geojson", "w") as f:
        json.dump(fc, f)
    manifest = spark.createDataFrame([("bikeways", "i1", "geojson", f"{out}/b.geojson"),
                                      ("bikeways", "i1", "shapefile", f"{out}/b.zip"),
                                      ("bikeways", "i1", "csv", f"{out}/none.csv")],
                                     geo_datasets.MANIFEST_SCHEMA)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS geo_layers_test LOCATION '{out}/gh'")
    res = geo_datasets.run(spark, manifest, "geo_layers_test")
    assert res.first().ok and spark.table("geo_layers_test.bikeways").first().geometry_type == "Point"


class PortalFetcher:
    """A portal dataset of n rows as list-of-lists pages (header first)."""

    def __init__(self, n: int):
        self.n = n

    def count(self):
        return self.n

    def fetch(self, offset, limit):
        head = ["Request Type", "Created Date", "Amount", "Open?", "Geo", ":sid", ":created_at", ":updated_at"]
        rows = [[f"t{i % 3}", "2024-01-01T00:00:00.000", str(i * 1.5), "true" if i % 2 else "false",
                 f"POINT ({i} {i + 1})", f"row-{i}", "2024-01-02T00:00:00.000", "2024-01-03T00:00:00.000"]
                for i in range(offset, min(offset + limit, self.n))]
        return [head] + rows


def test_portal_import(spark, out):
    meta = {"description": "It's the 311 data", "rowsUpdatedAt": 1719819000, "columns": [
        {"name": "Request Type", "dataTypeName": "text"}, {"name": "Created Date", "dataTypeName": "calendar_date"},
        {"name": "Amount", "dataTypeName": "money"}, {"name": "Open?", "dataTypeName": "checkbox"},
        {"name": "Geo", "dataTypeName": "point"}, {"name": "Ghost", "dataTypeName": "text"}]}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS portal_test LOCATION '{out}/p'")
    res = portal_import.run(spark, "abcd-1234", "tests.test_jobs:PortalFetcher", {"n": 250}, json.dumps(meta),
                            table="portal_test.requests", warehouse="postgres", page_size=100,
                            metadata_path=f"{out}/meta", extract_root=f"{out}/extracts")
    assert res.schema.drifted == ["ghost"] and res.schema.point_columns == ["geo"]
    t = spark.table("portal_test.requests")
    assert t.count() == 250
    r = t.where("id = 'row-3'").first()
    assert r.geo == "(3, 4)" and r.open is True and r.amount == 4.5 and str(r.createddate) == "2024-01-01 00:00:00"
    descr = [x.description for x in spark.catalog.listTables("portal_test") if x.name == "requests"][0]
    assert descr == "It's the 311 data"
    with pytest.raises(ValueError, match="no rows"):
        portal_import.run(spark, "empty", "tests.test_jobs:PortalFetcher", {"n": 0}, json.dumps(meta))


def test_catalog_report(spark, out):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tiger LOCATION '{out}/tiger'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS civic_test LOCATION '{out}/civic'")
    spark.sql("CREATE TABLE IF NOT EXISTS tiger.tracts (a int) USING parquet")
    spark.sql("CREATE TABLE IF NOT EXISTS civic_test.zones (a int) USING parquet COMMENT 'Zoning' "
              "TBLPROPERTIES ('geometry' = 'MULTIPOLYGON', 'crs' = 'EPSG:2229')")
    rows = {(r.schema, r.table): r for r in catalog_report.run(spark).collect()}
    assert ("civic_test", "zones") in rows and not any(s == "tiger" for s, _ in rows)
    z = rows[("civic_test", "zones")]
    assert (z.description, z.geometry, z.crs) == ("Zoning", "MULTIPOLYGON", "EPSG:2229")


def test_streaming_ingest(spark, out):
    land = f"{out}/landing"
    import os

    os.makedirs(land)
    with open(f"{land}/day1.json", "w") as f:
        f.write('{"k": 1, "v": "a"}\n{"k": 1, "v": "b"}\n{"k": null, "v": "n"}\n')
    args = dict(schema="k int, v string", target=f"{out}/t", keys=["k"], checkpoint=f"{out}/ckpt")
    ingest_available(spark, land, **args)
    with open(f"{land}/day2.json", "w") as f:
        f.write('{"k": 1, "v": "c"}\n{"k": 2, "v": "d"}\n')
    ingest_available(spark, land, **args)
    ingest_available(spark, land, **args)  # nothing new
    got = sorted((r.k or 0, r.v) for r in read_ingested(spark, f"{out}/t", "k int, v string").collect())
    assert got == [(0, "n"), (1, "a"), (2, "d")]


def test_portal_dated_outputs(out):
    import os

    names = os.listdir(f"{out}") if os.path.exists(out) else []
    assert portal_import.dated_name("abcd-1234", "extract", dt.date(2024, 7, 1)) == "abcd-1234_extract_2024-07-01.csv"
    assert portal_import.dated_name("abcd-1234", "metadata", dt.date(2024, 7, 1)) == "abcd-1234_metadata_2024-07-01.json"
    assert isinstance(names, list)


def test_geo_requires_input(spark):
    with pytest.raises(ValueError, match="manifest"):
        geo_datasets.run(spark)


def test_stop_times_migrate_and_snapshot_after_empty(spark, out):
    rows = [_stop(1.0, "Main", "2024-07-01T07:30:00Z"), _stop(1.0, "Main", "2024-07-01T07:30:00Z", ons=5)]
    with open(f"{out}/d.json", "w") as f:
        json.dump(rows, f)
    stop_times.run(spark, f"{out}/d.json", f"{out}/t", day="2024-06-30")
    with open(f"{out}/empty.json", "w") as f:
        f.write("[]")
    # an empty export still snapshots the day from the table
    assert stop_times.run(spark, f"{out}/empty.json", f"{out}/t", day="2024-06-30", snapshot_root=f"{out}/s") is False
    assert spark.read.parquet(f"{out}/s").count() == 1
    stop_times.migrate(spark, f"{out}/t", f"{out}/m")
    m = spark.read.parquet(f"{out}/m")
    assert m.columns == [*stop_times.STOP_TIMES.names, stop_times.ARRIVE_DAY] and m.count() == 1
    assert m.first()[stop_times.ARRIVE_DAY] == dt.date(2024, 6, 30)
    local = stop_times.local_view(m).first()
    assert str(local.scheduled_arrive) == "2024-07-01 00:30:00"


def test_portal_import_varchar_overflow(spark, out):
    meta = {"columns": [{"name": "Request Type", "dataTypeName": "text"}]}
    with pytest.raises(Exception, match="VARCHAR"):
        portal_import.run(spark, "abcd-1234", "tests.test_jobs:PortalFetcher", {"n": 10}, json.dumps(meta),
                          table=None, warehouse="redshift", varchar_len=1, metadata_path=None,
                          extract_root=f"{out}/x")


def test_streaming_replayed_batch_is_written_once(spark, out):
    write = batch_writer(spark, f"{out}/t", ["k"])
    batch = spark.createDataFrame([(None, "n", "f1", 0), (1, "a", "f1", 0)], "k int, v string, __file string, __start long")
    write(batch, 0)
    write(batch, 0)  # the same batch replayed after a lost commit
    write(batch, 1)  # a new batch with the same rows: only the null key inserts again
    got = sorted((r.k or 0, r.v) for r in read_ingested(spark, f"{out}/t", "k int, v string").collect())
    assert got == [(0, "n"), (0, "n"), (1, "a")]


def test_streaming_target_keeps_partition_types(spark, out):
    write = batch_writer(spark, f"{out}/t", ["d", "k"], partition_col="d")
    rows = [("01", 1, "a", "f1", 0), ("02", 1, "b", "f1", 0), (None, 1, "n", "f1", 0)]
    schema = "d string, k int, v string, __file string, __start long"
    write(spark.createDataFrame(rows, schema), 0)
    write(spark.createDataFrame([("01", 1, "late", "f2", 0), ("03", 1, "c", "f2", 0)], schema), 1)
    got = {tuple(r) for r in read_ingested(spark, f"{out}/t", "d string, k int, v string").collect()}
    assert got == {("01", 1, "a"), ("02", 1, "b"), (None, 1, "n"), ("03", 1, "c")}


def test_stop_time_ids_keep_every_digit(spark, out):
    ids = [9007199254740993, 9007199254740992, "12.0", "1.3E1"]
    rows = [_stop(i, "Main", "2024-07-01T07:30:00Z") for i in ids]
    with open(f"{out}/d.json", "w") as f:
        json.dump(rows, f)
    stop_times.run(spark, f"{out}/d.json", f"{out}/t", day="2024-06-30")
    assert sorted(r.trip_id for r in spark.read.parquet(f"{out}/t").collect()) == [12, 13, 2**53, 2**53 + 1]
    for bad in ("12.5", "abc", 2.7):
        with open(f"{out}/b.json", "w") as f:
            json.dump([_stop(bad, "Main", "2024-07-01T07:30:00Z")], f)
        with pytest.raises(Exception, match="unparseable value in 'trip_id'"):
            stop_times.load(spark, f"{out}/b.json", f"{out}/u")


def test_catalog_listing_named_catalog(spark, out):
    from tablepipe.operators.catalog import catalog_listing

    spark.sql(f"CREATE DATABASE IF NOT EXISTS civic_two LOCATION '{out}/c2'")
    spark.sql("CREATE TABLE IF NOT EXISTS civic_two.parks (a int) USING parquet COMMENT 'Parks'")
    rows = catalog_listing(spark, catalogs=["spark_catalog"], databases=["civic_two"]).collect()
    assert [(r.catalog, r.schema, r.table, r.description) for r in rows] == [
        ("spark_catalog", "civic_two", "parks", "Parks")]


def _scratch(spark):
    import os

    from tablepipe.session import ensure_checkpoint_dir

    root = f"{ensure_checkpoint_dir(spark)}/tablepipe-scratch".removeprefix("file:")
    return {f for f in os.listdir(root) if not f.startswith(".")} if os.path.isdir(root) else set()


def test_stop_times_files_follow_the_days(spark, out):
    """A load and a reload of many days write about a file a day, not one of every day a task, and
    leave nothing in scratch."""
    import glob
    import os

    days = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(40)]
    rows = [_stop(t, stop, f"{d}T{h:02}:30:00Z", ons=k) for d in days for h in (9, 12, 17) for t in (1, 2)
            for stop in ("Elm", "Oak") for k in (1, 2)]
    with open(f"{out}/d.json", "w") as f:
        json.dump(rows, f)
    before = _scratch(spark)
    stop_times.load(spark, f"{out}/d.json", f"{out}/t")
    assert os.path.exists(f"{out}/d.json")
    stop_times.load(spark, f"{out}/d.json", f"{out}/t2", keep_export=False)
    assert not os.path.exists(f"{out}/d.json")
    twice = spark.read.parquet(f"{out}/t")
    twice.unionByName(twice.withColumn("ons", F.lit(9).cast("bigint"))).write.parquet(f"{out}/s")
    stop_times.migrate(spark, f"{out}/s", f"{out}/m")
    assert _scratch(spark) - {f for f in _scratch(spark) if f.startswith("pyfiles")} <= before
    tasks = spark.sparkContext.defaultParallelism
    for path in ("t", "t2", "m"):
        got = spark.read.parquet(f"{out}/{path}")
        assert got.count() == 40 * 3 * 2 * 2 and got.select("ons").distinct().collect()[0][0] == 1
        files = glob.glob(f"{out}/{path}/arrive_day=*/*.parquet")
        assert 40 <= len(files) < 40 + tasks


def test_stop_times_migrate_query_drops_what_it_has_used(spark, monkeypatch):
    from tablepipe.plans import queries

    from .conftest import SF_SMALL

    before, at, migrate = _scratch(spark), [], stop_times.migrate

    def watched(*args):
        at.append(_scratch(spark) - before)
        migrate(*args)

    monkeypatch.setattr(stop_times, "migrate", watched)
    rows = queries()["stop_times_migrate"](spark, SF_SMALL)
    kinds = [sorted(f.split("-")[0] + ("-source" if f.endswith("-source") else "") for f in x
                    if not f.startswith("pyfiles")) for x in (at[0], _scratch(spark) - before)]
    assert kinds == [["stop_times_moved-source"], ["stop_times_moved"]]
    assert rows.count() > 0
