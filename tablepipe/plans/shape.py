"""Reshape queries: measure pivot, duplicates, first non-null."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.operators.names import rename_snake
from tablepipe.operators.reshape import (
    first_nonnull,
    measure_pivot,
    measure_pivot_join,
    melt,
    pivot_duplicates,
)
from tablepipe.plans._base import query, table

PART_MEASURES = {"Size": "CAST(p_size AS DOUBLE)", "Retail Price": "p_retailprice"}
PART_SQL = ("SELECT p_partkey, p_name, p_brand, CAST(p_size AS DOUBLE) AS size, "
            "p_retailprice AS retail_price FROM part")
EVENT_TYPES = ["click", "view", "signup", "error", "purchase"]


def _part_long(spark, sf):
    return melt(table(spark, sf, "part"), ["p_partkey", "p_name", "p_brand"], PART_MEASURES,
                pos_col="pos")


@query("measure_pivot", PART_SQL)
def q_measure_pivot(spark, sf):
    wide = measure_pivot(_part_long(spark, sf), "p_partkey", "measure", "value",
                         list(PART_MEASURES), attributes=["p_name", "p_brand"], order_by="pos")
    return rename_snake(wide)


@query("measure_pivot_join", PART_SQL)
def q_measure_pivot_join(spark, sf):
    wide = measure_pivot_join(_part_long(spark, sf), "p_partkey", "measure", "value",
                              list(PART_MEASURES), attributes=["p_name", "p_brand"], order_by="pos")
    return rename_snake(wide)


@query("pivot_duplicates", "SELECT user_id, event_type, count(*) AS n FROM events "
                           "GROUP BY user_id, event_type HAVING count(*) > 1")
def q_pivot_duplicates(spark, sf):
    return pivot_duplicates(table(spark, sf, "events"), "user_id", "event_type")


@query("first_nonnull",
       "SELECT user_id, arg_min(NULLIF(event_type, 'error'), ts) "
       "FILTER (WHERE NULLIF(event_type, 'error') IS NOT NULL) AS event_type "
       "FROM events GROUP BY user_id")
def q_first_nonnull(spark, sf):
    ev = table(spark, sf, "events").select(
        "user_id", "ts", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return first_nonnull(ev, "user_id", ["event_type"], order_by="ts")


@query("event_first_pivot",
       "SELECT user_id, "
       + ", ".join(f"arg_min(value, ts) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)
       + " FROM events GROUP BY user_id")
def q_event_first_pivot(spark, sf):
    return measure_pivot(table(spark, sf, "events"), "user_id", "event_type", "value",
                         EVENT_TYPES, order_by="ts", on_duplicate="first")
