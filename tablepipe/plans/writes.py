"""Sink and typed-source queries; each writes under the shared scratch folder
and returns what a reader of the written data sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.functions.timeops import local_date, us_datetime_text
from tablepipe.jobs.portal_import import dated_name
from tablepipe.operators.contract import TableContract
from tablepipe.operators.filters import day_slice
from tablepipe.operators.names import rename_snake
from tablepipe.operators.sinks import (
    append_ignore_conflicts,
    dedup_first,
    export_csv,
    export_single_csv,
    replace_table,
    truncate_and_load,
    write_snapshot,
    write_table,
)
from tablepipe.plans._base import LINEITEM_COLS, LINEITEM_ORDER, query, table
from tablepipe.session import scratch_path
from tablepipe.sources.typed import read_typed_csv, read_typed_json

KEYS = ["l_orderkey", "l_linenumber"]
ORDERS_CONTRACT = TableContract.from_ddl(
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string", keys=["o_orderkey"], name="orders")

_FIRST = (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
          f"l_linenumber ORDER BY {LINEITEM_ORDER}) AS rn FROM {{src}}) WHERE rn = 1")
_TARGET = _FIRST.format(src="lineitem WHERE l_linenumber <= 3")
_NULLED = ("(SELECT l_orderkey, l_partkey, l_suppkey, NULLIF(l_linenumber, 5) AS l_linenumber, "
           "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate "
           "FROM lineitem)")


def _conflict_sql(batch_src: str, null_rows: bool) -> str:
    sql = (f"WITH t AS ({_TARGET}), b AS ({_FIRST.format(src=batch_src + ' WHERE l_linenumber IS NOT NULL')}) "
           "SELECT * FROM t UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t "
           "WHERE t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber)")
    if null_rows:
        sql += f" UNION ALL SELECT * FROM {batch_src} WHERE l_linenumber IS NULL"
    return sql


def _conflict_run(spark, sf, batch):
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "conflict_target")
    target = dedup_first(li.where(F.col("l_linenumber") <= 3), KEYS, LINEITEM_COLS)
    target.write.mode("overwrite").parquet(path)
    append_ignore_conflicts(batch, path, KEYS, order_by=LINEITEM_COLS)
    return spark.read.parquet(path)


@query("conflict_append", _conflict_sql("lineitem", null_rows=False))
def q_conflict_append(spark, sf):
    return _conflict_run(spark, sf, table(spark, sf, "lineitem"))


@query("conflict_append_nullkeys", _conflict_sql(_NULLED, null_rows=True))
def q_conflict_append_nullkeys(spark, sf):
    batch = table(spark, sf, "lineitem").withColumn(
        "l_linenumber", F.nullif(F.col("l_linenumber"), F.lit(5)))
    return _conflict_run(spark, sf, batch)


@query("truncate_reload", "SELECT * FROM orders")
def q_truncate_reload(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "reload_orders")
    orders.where(F.col("o_orderkey") % 7 == 0).write.parquet(path)  # stale content to replace
    truncate_and_load(orders, path, contract=ORDERS_CONTRACT, on_duplicate="raise")
    return spark.read.parquet(path)


@query("truncate_reload_dedup", _FIRST.format(src="lineitem").replace("* EXCLUDE (rn)", LINEITEM_ORDER))
def q_truncate_reload_dedup(spark, sf):
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "reload_lineitem")
    truncate_and_load(li, path, keys=KEYS, on_duplicate="first", order_by=LINEITEM_COLS)
    return spark.read.parquet(path)


@query("snapshot_roundtrip", "SELECT * FROM orders")
def q_snapshot_roundtrip(spark, sf):
    path = scratch_path(spark, "snapshot_orders")
    write_snapshot(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@query("csv_export_roundtrip", "SELECT * FROM orders")
def q_csv_export_roundtrip(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "export_orders")
    export_csv(orders, path)
    return (spark.read.schema(orders.schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))


@query("day_partition_overwrite",
       "SELECT event_id, ts, user_id, event_type, CASE WHEN CAST(ts - INTERVAL 8 HOUR AS DATE) = "
       "DATE '2024-01-15' THEN value * 2 ELSE value END AS value, props, "
       "CAST(ts - INTERVAL 8 HOUR AS DATE) AS service_date FROM events")
def q_day_partition_overwrite(spark, sf):
    ev = table(spark, sf, "events").withColumn("service_date", local_date("ts", "-08:00"))
    path = scratch_path(spark, "events_by_day")
    write_snapshot(ev, path, partition_col="service_date")
    redo = day_slice(ev, "ts", "2024-01-15", zone="-08:00").withColumn("value", F.col("value") * 2)
    write_snapshot(redo, path, partition_col="service_date")  # replaces that day only
    return spark.read.schema(ev.schema).parquet(path).select(*ev.columns)


@query("csv_thousands",
       "SELECT l_orderkey, l_linenumber, l_extendedprice AS extended_price, l_shipdate AS ship_date "
       "FROM lineitem")
def q_csv_thousands(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias("Line Number"),
        F.format_number("l_extendedprice", 2).alias("Extended Price"),
        us_datetime_text("l_shipdate").alias("Ship Date"))
    path = scratch_path(spark, "lineitem_csv")
    li.write.option("header", True).csv(path)
    typed = read_typed_csv(spark, path,
                           types={"Order Key": "bigint", "Line Number": "int",
                                  "Extended Price": "double", "Ship Date": "timestamp_ntz"},
                           ts_formats={"Ship Date": "M/d/yyyy h:mm:ss a"})
    return rename_snake(typed).withColumnsRenamed(
        {"order_key": "l_orderkey", "line_number": "l_linenumber"})


@query("json_scan",
       "SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, "
       "c_mktsegment FROM customer")
def q_json_scan(spark, sf):
    path = scratch_path(spark, "customer_json")
    table(spark, sf, "customer").write.json(path)
    return read_typed_json(spark, path, "c_custkey bigint, c_name string, c_nationkey string, "
                           "c_acctbal double, c_mktsegment string", multi_line=False)


@query("typed_load", "SELECT r_regionkey, r_name FROM region")
def q_typed_load(spark, sf):
    """Region through CSV into a catalog table with a declared contract."""
    path = scratch_path(spark, "region_csv")
    table(spark, sf, "region").write.option("header", True).csv(path)
    raw = read_typed_csv(spark, path)  # all text, as a warehouse load file
    contract = TableContract.from_ddl("r_regionkey int, r_name string", keys=["r_regionkey"])
    name = _scratch_table(spark, "region_load")
    write_table(raw, name, contract=contract, existing="drop")
    return spark.table(name)


def _scratch_table(spark, stem: str) -> str:
    import uuid

    db = "tablepipe_scratch"
    loc = scratch_path(spark, "warehouse")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loc}'")
    return f"{db}.{stem}_{uuid.uuid4().hex[:10]}"


@query("table_replace", "SELECT * FROM events")
def q_table_replace(spark, sf):
    """A partitioned table replaced by other partitions; a third load fails half-way and leaves it."""
    ev = table(spark, sf, "events")
    name = _scratch_table(spark, "events_replaced")
    replace_table(ev.withColumn("event_type", F.concat(F.lit("old-"), "event_type")), name, ["event_type"])
    replace_table(ev, name, ["event_type"])
    broken = ev.withColumn("props", F.when(F.col("event_id") % 97 == 0, F.raise_error(F.lit("broken row"))).otherwise(F.col("props")))
    try:
        replace_table(broken, name, ["event_type"])
    except Exception as e:  # noqa: BLE001 - the load must fail for this reason only
        if "broken row" not in str(e):
            raise
    return spark.table(name).select(*ev.columns)


@query("table_truncate", " UNION ALL ".join(
    f"SELECT *, '{kind}' AS kind FROM events WHERE event_type = 'click'" for kind in ("found", "listed")))
def q_table_truncate(spark, sf):
    """Tables with a partition per event type, reloaded with clicks only: no other partition
    stays, whether partitions are found in the folder or listed by the catalog."""
    ev = table(spark, sf, "events")
    out = []
    for kind in ("found", "listed"):
        name = _scratch_table(spark, f"events_{kind}")
        if kind == "found":
            replace_table(ev, name, ["event_type"])
        else:
            ev.write.partitionBy("event_type").saveAsTable(name)
        truncate_and_load(ev.where("event_type = 'click'"), name)
        out.append(spark.table(name).select(*ev.columns, F.lit(kind).alias("kind")))
    return out[0].unionByName(out[1])


@query("append_pruned",
       "SELECT *, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-12' OR event_id % 2 = 0")
def q_append_pruned(spark, sf):
    """A batch of three days appended to a table partitioned by day that has half of one of them:
    only those days are read, behind a filter of the batch's keys."""
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    target = scratch_path(spark, "events_by_day")
    day = F.col("day")
    ev.where((day < F.lit("2024-01-12").cast("date")) | ((F.col("event_id") % 2 == 0) & (day != F.lit("2024-01-13").cast("date")))
             ).write.partitionBy("day").parquet(target)
    batch = ev.where(day.between(F.lit("2024-01-11").cast("date"), F.lit("2024-01-13").cast("date")))
    batch = batch.where((day < F.lit("2024-01-12").cast("date")) | (F.col("event_id") % 2 == 0))
    append_ignore_conflicts(batch, target, ["event_id"], order_by=["ts"], partition_col="day", bloom=True)
    return spark.read.schema(ev.schema).parquet(target).select(*ev.columns)


@query("single_csv", "SELECT * FROM orders")
def q_single_csv(spark, sf):
    """A dated extract as one CSV file with one header line, read back."""
    orders = table(spark, sf, "orders")
    path = f"{scratch_path(spark, 'extract')}/{dated_name('orders', 'extract')}"
    export_single_csv(orders, path)
    back = spark.read.schema(orders.schema).option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return back.option("mode", "FAILFAST").csv(path)
