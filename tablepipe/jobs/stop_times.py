"""Bus stop times: a daily JSON export appended without conflicts, then the
day's slice written to a date partition.

The load keeps instants (``timestamp``); rendering them in US/Pacific is a
display concern. The snapshot day is a fixed UTC-8 day, as the warehouse
query of the original reads 'PST' - the two zones are kept distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.functions.text import parsed_or_fail
from tablepipe.functions.timeops import local_date, utc_wall
from tablepipe.operators.contract import (
    TableContract,
    check_contract,
    enforce_not_null,
    integer_columns,
)
from tablepipe.operators.filters import day_slice, drop_null_keys, drop_strict
from tablepipe.operators.sinks import (
    append_ignore_conflicts,
    dedup_first,
    delete_path,
    files_go,
    replace_path,
    with_file_order,
    write_snapshot,
    write_table,
)
from tablepipe.session import scratch_path
from tablepipe.sources.typed import read_typed_json

# Display zone, snapshot-day zone, instant columns, dropped columns.
LOCAL_ZONE = "America/Los_Angeles"
SNAPSHOT_ZONE = "-08:00"
TIME_COLUMNS = ["arrive", "depart", "scheduled_arrive", "scheduled_depart"]
DROPPED = ["driver_first_name", "driver_last_name"]

# Partition column of the target: the snapshot-zone day of a key's time.
ARRIVE_DAY = "arrive_day"

# The declared columns of the export and its unique key.
STOP_TIMES = TableContract.from_ddl(
    "arrival_passengers bigint, arrive timestamp, arrive_variance double, block_href string, "
    "depart timestamp, depart_variance double, departure_passengers bigint, driver_href string, "
    "offs bigint, ons bigint, pattern_href string, pattern_name string, route_href string, "
    "route_name string, run_href string, run_name string, scheduled_arrive timestamp, "
    "scheduled_depart timestamp, stop_href string, stop_name string, trip_id bigint, "
    "trip_href string, trip_name string, vehicle_href string, vehicle_name string",
    keys=["scheduled_arrive", "stop_name", "trip_id"], name="stop_times")


def export_schema() -> str:
    """The export as read: the declared columns plus the driver names that are dropped.
    trip_id keeps its text, so that an id above 2^53 is not rounded on the way."""
    cols = []
    for f in STOP_TIMES.schema.fields:
        t = "string" if f.name == "trip_id" else f.dataType.simpleString()
        cols.append(f"{f.name} {t}")
    return ", ".join(cols + [f"{c} string" for c in DROPPED])


def whole_number(text) -> Column:
    """An integer id from its text, which may be written as a float (``12.0``, ``1.2E1``);
    null for any other text."""
    exact = F.trim(text).try_cast("decimal(38,6)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def prepare(raw: DataFrame) -> DataFrame:
    """Drop driver names, drop rows without a trip id, make it an integer (text that is none
    fails the load), add the target's partition day, and keep the declared columns (plus the
    arrival order when present)."""
    df = drop_strict(raw, *DROPPED)
    df = drop_null_keys(df, ["trip_id"])
    trip = F.col("trip_id")
    df = df.withColumns({"trip_id": parsed_or_fail(trip, whole_number(trip), "trip_id"),
                         ARRIVE_DAY: local_date(utc_wall("scheduled_arrive"), SNAPSHOT_ZONE)})
    extra = ["__ord"] if "__ord" in df.columns else []
    return df.select(*STOP_TIMES.names, ARRIVE_DAY, *extra)


def load(spark: SparkSession, json_path: str, target: str, multi_line: bool = True, keep_export: bool = True) -> bool:
    """Append the export; False when it was empty (a holiday or missing data). Only the
    target's days that the export has are read. The parsed rows and the shuffle files go when
    the load ends; with ``keep_export=False`` the export itself (an array file that is a scratch
    copy of the caller's) goes as soon as its rows are parsed, also when the load then fails."""
    stage = scratch_path(spark, "stop_times_rows")
    try:
        raw = read_typed_json(spark, json_path, export_schema(), multi_line=multi_line, order_col="__ord", stage=stage)
        if multi_line and not keep_export:
            delete_path(spark, json_path)
        rows = raw.count()
        if not rows:
            return False
        df = prepare(raw)
        check_contract(df, STOP_TIMES)  # names and types: plan time, no data read
        # an integer column holding a null fails the load; the guard rides in the
        # append itself, whose failed job commits nothing
        df = enforce_not_null(df, integer_columns(STOP_TIMES))
        with files_go(spark):
            append_ignore_conflicts(df, target, STOP_TIMES.keys, order_by="__ord", partition_col=ARRIVE_DAY, rows=rows)
        return True
    finally:
        delete_path(spark, stage)


def snapshot_day(spark: SparkSession, target: str, day, root: str, zone: str = SNAPSHOT_ZONE) -> bool:
    """Write the target's rows of local ``day`` to ``root/service_date=day``;
    nothing is written for an empty day; other days are untouched."""
    tgt = spark.table(target) if "/" not in target else spark.read.parquet(target)
    sliced = day_slice(tgt.select(*STOP_TIMES.names), "scheduled_depart", day, zone=zone)
    sliced = sliced.withColumn("service_date", local_date(utc_wall("scheduled_depart"), zone))
    return write_snapshot(sliced, root, partition_col="service_date", skip_empty=True)


def local_view(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The time columns as wall clocks in the local zone (display only)."""
    from tablepipe.functions.timeops import to_wall_clock

    return df.withColumns({c: to_wall_clock(utc_wall(c), zone) for c in TIME_COLUMNS})


def run(spark: SparkSession, json_path: str, target: str, day, snapshot_root: str | None = None,
        multi_line: bool = True) -> bool:
    """Load the day's export (nothing for an empty export), then snapshot the
    day from the table - which also runs after an empty export, and writes
    nothing when the day has no rows. Returns whether the export had rows."""
    loaded = load(spark, json_path, target, multi_line=multi_line)
    if snapshot_root:
        snapshot_day(spark, target, day, snapshot_root)
    return loaded


def migrate(spark: SparkSession, source_path: str, target: str) -> None:
    """Truncate and reload from a parquet source, ignoring conflicts; the
    contract is checked (the original skipped it)."""
    source = spark.read.parquet(source_path)
    df = with_file_order(source.select(*STOP_TIMES.names))
    check_contract(df, STOP_TIMES)
    df = dedup_first(df, STOP_TIMES.keys, "__ord", source.count(), ranges=True).select(*STOP_TIMES.names)
    df = df.withColumn(ARRIVE_DAY, local_date(utc_wall("scheduled_arrive"), SNAPSHOT_ZONE))
    with files_go(spark):
        if "/" in target:
            replace_path(df, target, partition_by=[ARRIVE_DAY])
        else:
            write_table(df, target, existing="truncate")
