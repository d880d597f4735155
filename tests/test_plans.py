"""Plan shape: the properties that matter at scale, read from explain()."""

import datetime as dt

from pyspark.sql import functions as F

from tablepipe.operators import sinks
from tablepipe.operators.reshape import measure_pivot
from tablepipe.operators.sinks import append_ignore_conflicts, plan_append, rows_to_append
from tablepipe.plans import queries

from .conftest import SF_SMALL


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_key_is_cut_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("o"), F.lit("v").alias("v"))
    plan = _plan(rows_to_append(df, df.limit(0), ["k"], "o"))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    long = df.select("k", "o", F.lit("m").alias("name"), F.col("o").cast("double").alias("value"))
    pivot = _plan(measure_pivot(long, "k", "name", "value", ["m"], order_by="o", on_duplicate="first"))
    assert "partial_min_by" in pivot


def test_known_rows_are_dealt_before_they_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_A_TASK", 100)
    df = spark.range(3000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("o"))
    for rows in (sinks.dedup_first(df, ["k"], "o", rows=3000), rows_to_append(df, df.limit(0), ["k"], "o", rows=3000)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        at = plan.index("hashpartitioning(k")
        assert ", 30)" in plan[at:at + 60] and "Sort" not in plan[at:].split("Range")[0]
        assert sorted((r.k, r.o) for r in rows.collect()) == [(i, i) for i in range(2000)]


def test_filters_reach_the_scan(spark):
    for name in ["day_slice_pst", "recent_exclude"]:
        plan = _plan(queries()[name](spark, SF_SMALL))
        pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
        assert pushed and ("GreaterThan" in pushed[0])


def test_projection_is_pruned(spark):
    plan = _plan(queries()["parquet_scan"](spark, SF_SMALL))
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "c_acctbal" in schema and "c_mktsegment" not in schema


def test_worklist_has_no_join(spark):
    plan = _plan(queries()["period_worklist"](spark, SF_SMALL))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_partitioned_target_is_pruned(spark, out):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    tgt = spark.createDataFrame([(d, i, "old") for i, d in enumerate(days)], "d date, k int, v string")
    tgt.write.partitionBy("d").parquet(f"{out}/t")
    batch = spark.createDataFrame([(days[2], 2, "new"), (days[2], 9, "add")], "d date, k int, v string")
    planned = plan_append(batch, f"{out}/t", ["d", "k"], "k", partition_col="d")
    parts = [ln for ln in _plan(planned).splitlines() if ln.startswith("PartitionFilters")]
    assert any("2024-01-03" in ln for ln in parts)
    append_ignore_conflicts(batch, f"{out}/t", ["d", "k"], "k", partition_col="d")
    got = sorted((r.k, r.v) for r in spark.read.parquet(f"{out}/t").collect())
    assert got == [(0, "old"), (1, "old"), (2, "old"), (9, "add")]
