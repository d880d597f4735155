import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablepipe.functions.timeops import day_bounds_utc, epoch_text, to_wall_clock
from tablepipe.operators.combine import choose_by_priority, period_worklist, union_by_name
from tablepipe.operators.filters import (
    cast_columns,
    day_slice,
    drop_strict,
    exclude_keep_nulls,
    exclude_sql,
    guard_empty,
    lookup_one,
    recent_exclude,
    sample_rows,
    split_rejects,
)


def test_two_not_equal_rules(spark):
    df = spark.createDataFrame([("Total",), ("Weekday",), (None,)], "day_type string")
    assert sorted(r[0] or "" for r in exclude_keep_nulls(df, "day_type", "Total").collect()) == ["", "Weekday"]
    assert [r[0] for r in exclude_sql(df, "day_type", "Total").collect()] == ["Weekday"]


def test_recent_exclude_boundaries(spark):
    as_of = dt.datetime(2024, 8, 31)
    rows = [(dt.datetime(2024, 2, 29), "A"),            # exactly 6 months: excluded (strict >)
            (dt.datetime(2024, 2, 29, 0, 0, 1), "A"),   # just inside
            (dt.datetime(2024, 3, 1), "Homeless Encampment"),
            (dt.datetime(2024, 3, 1), None), (None, "A")]
    df = spark.createDataFrame([(str(t) if t else None, r) for t, r in rows], "t string, r string") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = recent_exclude(df, "t", 6, as_of, "r", "Homeless Encampment").collect()
    assert [(str(r.t), r.r) for r in got] == [("2024-02-29 00:00:01", "A")]


def test_day_slice_fixed_offset_vs_dst(spark):
    # 07:30 UTC on July 1 is June 30 at UTC-8 but July 1 at 00:30 in Los Angeles (UTC-7)
    df = spark.createDataFrame([("2024-07-01 07:30:00",)], "ts string").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert day_slice(df, "ts", "2024-06-30", "-08:00").count() == 1
    assert day_slice(df, "ts", "2024-07-01", "America/Los_Angeles").count() == 1
    with pytest.raises(ValueError, match="abbreviation"):
        day_bounds_utc("2024-07-01", "PST")
    inst = spark.createDataFrame([(dt.datetime(2024, 7, 1, 7, 30, tzinfo=dt.timezone.utc),)], "ts timestamp")
    assert day_slice(inst, "ts", "2024-06-30", "-08:00").count() == 1


def test_wall_clock_and_epoch_text(spark):
    df = spark.createDataFrame([("2024-07-01 07:30:00", 1719819000)], "ts string, e long").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), "e")
    r = df.select(to_wall_clock("ts", "America/Los_Angeles").alias("la"),
                  epoch_text("e", "UTC").alias("u"), epoch_text(F.lit(None).cast("long"), "UTC").alias("n")).first()
    assert str(r.la) == "2024-07-01 00:30:00" and r.u == "2024-07-01 07:30" and r.n is None


def test_drop_cast_guards(spark):
    df = spark.createDataFrame([(2.7, "x")], "id double, s string")
    with pytest.raises(KeyError):
        drop_strict(df, "missing")
    assert cast_columns(df, {"id": "bigint"}).first().id == 2
    with pytest.raises(ValueError, match="no rows"):
        guard_empty(df.where("false"), "fail")
    assert guard_empty(df.where("false"), "skip").columns == ["id", "s"]
    with pytest.raises(LookupError):
        lookup_one(df, F.col("s") == "y")
    assert sample_rows(spark.range(100), 5, order_by="id").collect()[-1].id == 4


def test_split_rejects(spark):
    df = spark.createDataFrame([("ok page",), ("Data not available yet",), (None,)], "html string")
    ok, bad, _ = split_rejects(df, F.col("html").contains("Data not available yet"))
    assert ok.count() == 2 and bad.count() == 1


def test_union_priority_worklist(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, extra double")
    assert sorted(union_by_name(a, b).columns) == ["a", "extra", "k"]
    dist = spark.createDataFrame([("parcels", "csv", "u1"), ("parcels", "geojson", "u2"),
                                  ("parcels", "kml", "u0"), ("zoning", "csv", "u3"), ("x", "kml", "u4")],
                                 "table_name string, format string, url string")
    got = {r.table_name: r.format for r in choose_by_priority(dist, "table_name", "format",
                                                               ["shapefile", "geojson", "csv"], ["url"]).collect()}
    assert got == {"parcels": "geojson", "zoning": "csv"}
    years = spark.createDataFrame([("2023",), ("2024",), ("2025",)], "year string")
    lines = spark.createDataFrame([("801",), ("802",)], "line string")
    wl = period_worklist(years, lines, as_of=dt.date(2024, 3, 15))
    assert wl.count() == (12 + 2) * 2  # 2023 whole, Jan-Feb 2024, nothing of 2025
    assert wl.where("year = '2024' AND month = '3'").count() == 0


def test_parse_ts_is_zone_free(spark):
    from tablepipe.functions.timeops import parse_ts

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # clocks jumped at midnight
    try:
        df = spark.createDataFrame([("10/3/1999 12:00:00 AM", "1999-10-03 00:00:00"), ("bad", "x")], "a string, b string")
        r = df.select(parse_ts("a", "M/d/yyyy h:mm:ss a").alias("a"),
                      parse_ts("b", "yyyy-MM-dd HH:mm:ss").alias("b"),
                      parse_ts("b", ["M/d/yyyy", "yyyy-MM-dd HH:mm:ss"]).alias("c")).collect()
        assert [str(x) for x in r[0]] == ["1999-10-03 00:00:00"] * 3
        assert list(r[1]) == [None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
