"""Bike trips: one row per (trip, measure) in a CSV -> one row per trip.

read CSV (text) -> typed projection -> one ``groupBy(trip_id)`` with
conditional aggregates (partial per task, one exchange) -> header cleaning ->
contract -> append ignoring conflicts on ``trip_id`` -> optional snapshot.
``migrate`` reloads the table from a snapshot instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.functions.text import parse_integer, parse_number, parsed_or_fail
from tablepipe.functions.timeops import parse_ts
from tablepipe.operators.contract import TableContract, check_contract, conform
from tablepipe.operators.names import rename_snake
from tablepipe.operators.reshape import measure_pivot
from tablepipe.operators.sinks import append_ignore_conflicts, truncate_and_load, write_snapshot
from tablepipe.sources.typed import read_typed_csv

# The measures carried in the "Measure Names" column.
MEASURES = ["Distance", "Duration", "Est Calories", "Est Carbon Offset"]
# Columns forced to text so leading zeros survive.
TEXT_COLUMNS = ["Visible ID", "End Station", "Start Station"]
# The timestamp columns of the export.
TIME_COLUMNS = ["Start Datetime", "End Datetime"]
# Timestamp forms accepted when none is given: ISO text, then US exports.
TIME_FORMATS = [None, "M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy"]

# The declared columns of the table and its key.
BIKE_TRIPS = TableContract.from_ddl(
    "trip_id bigint, bike_type string, end_datetime timestamp_ntz, end_station string, "
    "end_station_name string, name_group string, optional_kiosk_id_group string, "
    "start_datetime timestamp_ntz, start_station string, start_station_name string, "
    "visible_id string, distance double, duration double, est_calories double, "
    "est_carbon_offset double", keys=["trip_id"], name="bike_trips")


def reshape(raw: DataFrame, ts_format=None) -> DataFrame:
    """Long CSV rows -> one typed row per trip with snake_case names.

    Only the key is typed before the aggregation; measure values and
    timestamps are parsed after it, once per trip instead of once per
    (trip, measure) row (a measure value is unique per trip, a repeat fails). A
    trip id, measure value or time that holds text but does not parse fails the
    load, and so does a measure that is not declared."""
    attrs = [c for c in raw.columns if c not in ("Trip ID", "Measure Names", "Measure Values", "__ord")]
    key = F.col("Trip ID")
    keyed = raw.withColumn("Trip ID", parsed_or_fail(key, parse_integer(key), "Trip ID"))
    wide = measure_pivot(keyed, "Trip ID", "Measure Names", "Measure Values", MEASURES,
                         attributes=attrs, order_by="__ord", on_duplicate="raise",
                         on_unknown="raise")
    parsed = {m: parse_number(F.col(f"`{m}`")) for m in MEASURES}
    parsed |= {c: parse_ts(F.col(f"`{c}`"), ts_format or TIME_FORMATS) for c in TIME_COLUMNS if c in attrs}
    wide = wide.withColumns({c: parsed_or_fail(F.col(f"`{c}`"), v, c) for c, v in parsed.items()})
    return rename_snake(wide)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text plus its arrival order (file, split, position)."""
    return read_typed_csv(spark, path, order_col="__ord")


def run(spark: SparkSession, csv_path: str, target: str, snapshot_path: str | None = None,
        ts_format: str | None = None) -> None:
    """Reshape the export, check the contract, append ignoring trips already
    loaded, then snapshot the whole table when a path is given."""
    trips = conform(reshape(read_trips(spark, csv_path), ts_format), BIKE_TRIPS)
    check_contract(trips, BIKE_TRIPS)
    append_ignore_conflicts(trips, target, BIKE_TRIPS.keys, order_by=["trip_id"], batch_unique=True)
    if snapshot_path:
        tgt = spark.table(target) if "/" not in target else spark.read.parquet(target)
        write_snapshot(tgt, snapshot_path, skip_empty=False)


def migrate(spark: SparkSession, snapshot_path: str, target: str) -> None:
    """Truncate and reload the table from its snapshot; a repeated trip id fails."""
    df = spark.read.parquet(snapshot_path)
    truncate_and_load(df, target, contract=BIKE_TRIPS, on_duplicate="raise")
