import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablepipe.operators.contract import TableContract
from tablepipe.operators.sinks import (
    append_ignore_conflicts,
    check_unique,
    dedup_first,
    export_csv,
    export_single_csv,
    key_filter,
    plan_append,
    replace_table,
    rows_to_append,
    truncate_and_load,
    write_snapshot,
    write_table,
)

SCHEMA = "k int, k2 string, v string, o int"


def test_rows_to_append_rules(spark):
    target = spark.createDataFrame([(1, "a", "old", 0)], SCHEMA)
    batch = spark.createDataFrame([
        (1, "a", "conflict", 1),      # existing row wins
        (2, "b", "second", 3), (2, "b", "first", 2),  # first by order wins
        (None, "c", "n1", 4), (None, "c", "n2", 5),   # null keys always insert
        (3, None, "n3", 6)], SCHEMA)
    got = sorted(r.v for r in rows_to_append(batch, target, ["k", "k2"], "o").collect())
    assert got == ["first", "n1", "n2", "n3"]


def test_order_required(spark):
    df = spark.createDataFrame([(1, "a", "x", 0)], SCHEMA)
    with pytest.raises(ValueError, match="order_by"):
        rows_to_append(df, df, ["k"], None)
    with pytest.raises(ValueError, match="order_by"):
        dedup_first(df, ["k"], [])


def test_append_twice_is_once(spark, out):
    path = f"{out}/target"
    batch = spark.createDataFrame([(1, "a", "x", 0), (2, "b", "y", 1), (2, "b", "z", 2)], SCHEMA)
    append_ignore_conflicts(batch, path, ["k", "k2"], "o")  # path does not exist yet
    append_ignore_conflicts(batch, path, ["k", "k2"], "o")
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "x"), (2, "y")]


def test_check_unique(spark):
    check_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])
    with pytest.raises(ValueError, match="duplicate"):
        check_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    with pytest.raises(ValueError, match="null"):
        check_unique(spark.createDataFrame([(1,), (None,)], "k int"), ["k"])
    check_unique(spark.createDataFrame([(None,), (None,)], "k int"), ["k"], allow_null=True)


def test_truncate_and_load(spark, out):
    path = f"{out}/t"
    c = TableContract.from_ddl("k int, v string", keys=["k"])
    spark.createDataFrame([(9, "stale")], "k int, v string").write.parquet(path)
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="duplicate"):
        truncate_and_load(dup, path, contract=c)
    assert [r.k for r in spark.read.parquet(path).collect()] == [9]  # nothing written on failure
    truncate_and_load(dup.withColumn("o", F.lit(0)).withColumn("o", F.when(F.col("v") == "b", 0).otherwise(1)),
                      path, keys=["k"], on_duplicate="first", order_by="o")
    assert [(r.k, r.v) for r in spark.read.parquet(path).collect()] == [(1, "b")]
    with pytest.raises(AssertionError, match="expected int"):
        truncate_and_load(spark.createDataFrame([(1, "a")], "k long, v string"), path, contract=c)


def test_snapshot_skip_empty_and_day_partitions(spark, out):
    path = f"{out}/snap"
    empty = spark.createDataFrame([], "d date, v int")
    assert write_snapshot(empty, path) is False
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "d date, v int")
    assert write_snapshot(days, path, partition_col="d")
    redo = spark.createDataFrame([(dt.date(2024, 1, 2), 20)], "d date, v int")
    write_snapshot(redo, path, partition_col="d")
    got = sorted((r.d, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 20)]


def test_export_csv_parts_have_headers(spark, out):
    df = spark.range(10).withColumn("t", F.lit("x")).repartition(3)
    export_csv(df, f"{out}/one")
    export_csv(df, f"{out}/one")  # replaces
    back = spark.read.option("header", True).csv(f"{out}/one")
    assert back.count() == 10 and back.columns == ["id", "t"]


def test_failed_loads_leave_the_old_data(spark, out):
    from tablepipe.operators.sinks import replace_path

    good = spark.range(5).withColumn("v", F.lit("a"))
    bad = good.withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise("b"))
    replace_path(good, f"{out}/t")
    for load in (lambda: replace_path(bad, f"{out}/t"), lambda: export_csv(bad, f"{out}/t"),
                 lambda: truncate_and_load(bad, f"{out}/t"), lambda: write_snapshot(bad, f"{out}/t")):
        with pytest.raises(Exception, match="boom"):
            load()
    assert sorted(map(tuple, spark.read.parquet(f"{out}/t").collect())) == [(i, "a") for i in range(5)]
    import os

    assert sorted(os.listdir(out)) == ["t"]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tp_swap LOCATION '{out}/wh'")
    write_table(good, "tp_swap.t")
    for policy in ("drop", "truncate"):
        with pytest.raises(Exception, match="boom"):
            write_table(bad, "tp_swap.t", existing=policy)
    assert spark.table("tp_swap.t").where("v = 'a'").count() == 5
    spark.sql("DROP DATABASE tp_swap CASCADE")


def test_unique_batches_are_read_once(spark, out):
    batch = spark.range(6).groupBy("id").agg(F.count("*").alias("n"))
    replace_path_ids = spark.range(3).withColumn("n", F.lit(0).cast("bigint"))
    replace_path_ids.write.parquet(f"{out}/t")
    plan = plan_append(batch, f"{out}/t", ["id"], ["id"], batch_unique=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in text and "Window" not in text
    assert sorted(r.id for r in plan.collect()) == [3, 4, 5]


def test_write_table_policies_and_comment(spark, out):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tp_test LOCATION '{out}/wh'")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_table(df, "tp_test.t1", existing="drop", comment="it's a table")
    write_table(df, "tp_test.t1", existing="append")
    assert spark.table("tp_test.t1").count() == 2
    write_table(df, "tp_test.t1", existing="truncate")
    assert spark.table("tp_test.t1").count() == 1
    with pytest.raises(Exception):
        write_table(df, "tp_test.t1", existing="fail")
    descr = [t.description for t in spark.catalog.listTables("tp_test") if t.name == "t1"][0]
    assert descr == "it's a table"


def test_snapshot_files_per_partition(spark, out):
    import os

    df = spark.range(2000).select((F.col("id") % 3).alias("d"), F.col("id").alias("v")).repartition(20)
    write_snapshot(df, f"{out}/s", partition_col="d", files_per_partition=2)
    for d in range(3):
        files = [f for f in os.listdir(f"{out}/s/d={d}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    assert spark.read.parquet(f"{out}/s").count() == 2000


def test_first_row_follows_file_order(spark, out):
    import os

    from tablepipe.sources.typed import read_typed_json

    os.makedirs(f"{out}/land")
    # the larger file sorts last by name but would be packed first by size
    with open(f"{out}/land/a.json", "w") as f:
        f.write('{"k": 1, "v": "a1"}\n{"k": 2, "v": "a2"}\n')
    with open(f"{out}/land/b.json", "w") as f:
        f.write("".join('{"k": %d, "v": "b"}\n' % (i % 3) for i in range(500)))
    df = read_typed_json(spark, f"{out}/land", "k int, v string", multi_line=False, order_col="__ord")
    got = {r.k: r.v for r in dedup_first(df, ["k"], "__ord").collect()}
    assert got == {1: "a1", 2: "a2", 0: "b"}


def _folders(path):
    import os

    return sorted(n for n in os.listdir(path) if not n.startswith("."))


def test_replace_table_switches_between_whole_versions(spark, out):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tp_versions LOCATION '{out}/wh'")
    df = spark.range(6).select("id", (F.col("id") % 3).cast("string").alias("part"))
    with pytest.raises(Exception, match="boom"):
        replace_table(df.withColumn("id", F.raise_error(F.lit("boom"))), "tp_versions.t", ["part"])
    assert not spark.catalog.tableExists("tp_versions.t")  # a first load that fails makes no table
    replace_table(df, "tp_versions.t", ["part"])
    old = spark.table("tp_versions.t")
    assert old.count() == 6 and len(_folders(f"{out}/wh")) == 1
    replace_table(df.where("part = '1'").withColumn("id", F.col("id") + 10), "tp_versions.t", ["part"])
    assert sorted(map(tuple, spark.table("tp_versions.t").collect())) == [(11, "1"), (14, "1")]
    replace_table(spark.table("tp_versions.t").withColumn("id", F.col("id") * 2), "tp_versions.t", ["part"])  # from itself
    assert sorted(map(tuple, spark.table("tp_versions.t").collect())) == [(22, "1"), (28, "1")]
    spark.sql("COMMENT ON TABLE tp_versions.t IS 'kept'")
    truncate_and_load(df.where("part = '2'"), "tp_versions.t")
    assert sorted(r.id for r in spark.table("tp_versions.t").collect()) == [2, 5]
    assert [t.description for t in spark.catalog.listTables("tp_versions")] == ["kept"]
    spark.table("tp_versions.t").write.insertInto("tp_versions.t")  # appends go to the current version
    assert spark.table("tp_versions.t").count() == 4
    # another schema and partitioning
    replace_table(spark.range(3).withColumn("x", F.lit(1.5)), "tp_versions.t")
    assert spark.table("tp_versions.t").columns == ["id", "x"] and spark.table("tp_versions.t").count() == 3
    assert len(_folders(f"{out}/wh")) == 1
    spark.sql("DROP TABLE tp_versions.t")
    assert _folders(f"{out}/wh") == []  # a dropped table leaves nothing
    spark.sql("DROP DATABASE tp_versions CASCADE")


def test_truncate_reaches_partitions_without_rows(spark, out):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tp_parts LOCATION '{out}/wh'")
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string").write.partitionBy("p").saveAsTable("tp_parts.listed")
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string").write.partitionBy("p").option("path", f"{out}/own").saveAsTable("tp_parts.own")
    for name in ("listed", "own"):
        for load in (lambda df, t: truncate_and_load(df, t), lambda df, t: write_table(df, t, existing="truncate")):
            load(spark.createDataFrame([(3, "x")], "a int, p string"), f"tp_parts.{name}")
            assert [tuple(r) for r in spark.table(f"tp_parts.{name}").collect()] == [(3, "x")]
            load(spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string"), f"tp_parts.{name}")
    import os

    assert os.path.isdir(f"{out}/own")  # an owner's folder stays where it is
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    spark.sql("DROP DATABASE tp_parts CASCADE")


def test_pruned_append_is_the_plain_append(spark, out):
    import random

    rng = random.Random(4)

    def rows(n, days):
        return [(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]), rng.choice(days)) for _ in range(n)]

    schema = "k long, s string, d int"
    target = dedup_first(spark.createDataFrame(rows(200, range(9)), schema), ["k", "s", "d"], "d")
    target.write.partitionBy("d").parquet(f"{out}/t")
    for days in ([3], [2, 3, 4, None], [7]):
        batch = spark.createDataFrame(rows(80, days), schema)
        want = sorted(map(str, rows_to_append(batch, spark.read.schema(schema).parquet(f"{out}/t"), ["k", "s", "d"], "k").collect()))
        for bloom in (False, True):
            plan = plan_append(batch, f"{out}/t", ["k", "s", "d"], "k", partition_col="d", bloom=bloom)
            assert sorted(map(str, plan.select("k", "s", "d").collect())) == want


def test_key_filter_passes_every_key_of_the_batch(spark):
    target = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("s"))
    batch = target.where("k % 1000 = 3")
    kept = {tuple(r) for r in key_filter(target, batch, ["k", "s"], 20).collect()}
    assert {tuple(r) for r in batch.collect()} <= kept and len(kept) < 100


def test_single_csv(spark, out):
    import csv
    import os

    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit('a "b", c')).alias("x, y")).repartition(5)
    for _ in range(2):  # the second replaces the first
        export_single_csv(df, f"{out}/one.csv")
    with open(f"{out}/one.csv", newline="") as f:
        rows = list(csv.reader(f, escapechar="\\"))
    assert rows[0] == ["id", "x, y"] and len(rows) == 1001 and sorted(int(r[0]) for r in rows[1:]) == list(range(1000))
    assert _folders(out) == ["one.csv"]
    with pytest.raises(Exception, match="boom"):
        export_single_csv(df.withColumn("id", F.raise_error(F.lit("boom")).cast("string")), f"{out}/one.csv")
    assert _folders(out) == ["one.csv"] and os.path.getsize(f"{out}/one.csv") > 1000
    export_single_csv(df.limit(0), f"{out}/none.csv")
    with open(f"{out}/none.csv") as f:
        assert f.read() == 'id,"x, y"\n'


def test_single_file_holds_its_data_once(spark, out, monkeypatch):
    """Parts are small, are copied in the order of their rows and go one by one."""
    import os

    from tablepipe.operators import sinks

    left, copy = [], sinks._copy_part

    def watched(spark, fs, part, *rest):
        folder = os.path.dirname(part.toUri().getPath())
        left.append(len([f for f in os.listdir(folder) if f.startswith("part-")]))
        copy(spark, fs, part, *rest)

    monkeypatch.setattr(sinks, "_copy_part", watched)
    monkeypatch.setattr(sinks, "PART_ROWS", 1)
    lines = spark.range(0, 1100, 1, 1).select(F.format_string(",%d", "id").alias("value"))  # one task, files c000 to c1099
    sinks.single_file(lines.write.format("text"), spark, f"{out}/a.json", head="[", tail="]", skip=1)
    with open(f"{out}/a.json") as f:
        assert f.read() == "[" + "\n,".join(str(i) for i in range(1100)) + "\n]"
    assert left == list(range(1100, 0, -1))
    assert [f for f in os.listdir(out) if not f.startswith(".")] == ["a.json"]


def test_dealt_by_ranges_chooses_the_same_rows(spark, monkeypatch):
    from tablepipe.operators import sinks

    monkeypatch.setattr(sinks, "ROWS_A_TASK", 50)
    df = spark.range(0, 600, 1, 7).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 37).alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("o"))
    got = dedup_first(df, ["a", "b"], "o", rows=600, ranges=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(a" in plan and "hashpartitioning" not in plan
    first, nulls = {}, []
    for r in df.collect():
        nulls.append(r.o) if r.a is None else first.setdefault((r.a, r.b), r.o)
    assert sorted(r.o for r in got.collect()) == sorted([*first.values(), *nulls])
