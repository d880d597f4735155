import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablepipe.jobs.bike_trips import MEASURES, reshape
from tablepipe.operators.reshape import (
    first_nonnull,
    measure_pivot,
    measure_pivot_join,
    melt,
    pivot_duplicates,
)

LONG = "trip int, ord long, station string, m string, v double"


def _long(spark, rows):
    return spark.createDataFrame(rows, LONG)


def test_pivot_first_nonnull_and_missing(spark):
    rows = [(1, 0, None, "Distance", 1.5), (1, 1, "A", "Duration", 10.0), (1, 2, "B", "Est Calories", 3.0),
            (2, 3, "C", "Distance", 2.0), (None, 4, "Z", "Distance", 9.0)]
    out = measure_pivot(_long(spark, rows), "trip", "m", "v", ["Distance", "Duration", "Est Calories"],
                        attributes=["station"], order_by="ord")
    got = {r.trip: r.asDict() for r in out.collect()}
    assert set(got) == {1, 2}  # null key dropped
    assert got[1]["station"] == "A"  # first non-null, not the first row
    assert got[1]["Duration"] == 10.0 and got[2]["Duration"] is None


def test_pivot_duplicate_raises(spark):
    rows = [(1, 0, "A", "Distance", 1.0), (1, 1, "A", "Distance", 2.0)]
    df = _long(spark, rows)
    with pytest.raises(Exception, match="duplicate"):
        measure_pivot(df, "trip", "m", "v", ["Distance"], attributes=["station"], order_by="ord").collect()
    first = measure_pivot(df, "trip", "m", "v", ["Distance"], order_by="ord", on_duplicate="first").collect()
    assert first[0]["Distance"] == 1.0
    dups = pivot_duplicates(df, "trip", "m").collect()
    assert [(r.trip, r.m, r.n) for r in dups] == [(1, "Distance", 2)]


def test_attributes_need_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        measure_pivot(_long(spark, [(1, 0, "A", "Distance", 1.0)]), "trip", "m", "v", ["Distance"],
                      attributes=["station"])


def test_first_nonnull(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, None), (1, 3, "c"), (2, 1, None)], "k int, o int, v string")
    got = {r.k: r.v for r in first_nonnull(df, "k", ["v"], "o").collect()}
    assert got == {1: "b", 2: None}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.floats(-1e6, 1e6, allow_nan=False),
                          st.one_of(st.none(), st.floats(0, 100, allow_nan=False))),
                min_size=1, max_size=12, unique_by=lambda t: t[0]))
def test_melt_then_pivot_roundtrip(spark, rows):
    wide = spark.createDataFrame(rows, "k int, a double, b double")
    long = melt(wide, ["k"], {"a": "a", "b": "b"}, pos_col="pos")
    back = measure_pivot(long, "k", "measure", "value", ["a", "b"])
    join = measure_pivot_join(long, "k", "measure", "value", ["a", "b"], attributes=[], order_by="pos")
    expect = sorted(rows)
    assert sorted(tuple(r) for r in back.collect()) == expect
    assert sorted(tuple(r) for r in join.collect()) == expect


def test_bike_reshape_from_csv(spark, out):
    path = f"{out}/trips.csv"
    with open(path, "w") as f:
        f.write("Trip ID,Start Datetime,End Datetime,Visible ID,Start Station,End Station,Bike Type,"
                "Start Station Name,End Station Name,Name (group),Optional Kiosk ID (group),"
                "Measure Names,Measure Values\n")
        f.write('1,2024-01-01 08:00:00,2024-01-01 08:30:00,007,03005,03006,,Main St,Oak St,G,K,'
                'Distance,"1,234.5"\n')
        f.write('1,2024-01-01 08:00:00,2024-01-01 08:30:00,007,03005,03006,electric,Main St,Oak St,G,K,'
                'Duration,30\n')
        f.write('2,1/2/2024 9:00:00 AM,1/2/2024 9:10:00 AM,010,03007,03005,smart,Elm St,Main St,G,K,'
                'Est Calories,12\n')
    from tablepipe.jobs.bike_trips import read_trips

    got = {r.trip_id: r for r in reshape(read_trips(spark, path)).collect()}
    assert got[1].distance == 1234.5 and got[1].duration == 30.0 and got[1].est_calories is None
    assert got[1].bike_type == "electric"  # first non-null across rows
    assert got[1].visible_id == "007" and got[1].start_station == "03005"  # leading zeros kept
    assert str(got[2].start_datetime) == "2024-01-02 09:00:00"
    assert len(MEASURES) == 4
