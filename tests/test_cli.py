"""The job command line, run in-process (it reuses the active session)."""

from tablepipe.jobs.__main__ import main

HEADER = ("Trip ID,Start Datetime,End Datetime,Visible ID,Start Station,End Station,Bike Type,"
          "Start Station Name,End Station Name,Name (group),Optional Kiosk ID (group),Measure Names,Measure Values\n")


def test_bike_trips_load_and_migrate(spark, out):
    with open(f"{out}/t.csv", "w") as f:
        f.write(HEADER + '7,1/2/2024 9:00:00 AM,1/2/2024 9:10:00 AM,007,03005,03006,e,A,B,G,K,Distance,"1,234.5"\n')
    main(["bike_trips", "load", f"{out}/t.csv", f"{out}/target", "--snapshot", f"{out}/snap"])
    main(["bike_trips", "migrate", f"{out}/snap", f"{out}/reloaded"])
    r = spark.read.parquet(f"{out}/reloaded").first()
    assert (r.trip_id, r.distance, r.visible_id, str(r.start_datetime)) == (7, 1234.5, "007", "2024-01-02 09:00:00")


def test_catalog_report(spark, out, capsys):
    main(["catalog_report", "--out", f"{out}/catalog"])
    assert spark.read.parquet(f"{out}/catalog").columns == ["catalog", "schema", "table", "description",
                                                            "geometry", "crs"]
