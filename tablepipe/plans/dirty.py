"""Queries over dirty input: rejects, failing loads, HTML without end tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablepipe.operators.sinks import replace_path
from tablepipe.plans._base import ORDERS_COLS, query, table
from tablepipe.session import scratch_path
from tablepipe.sources.html import html_options, html_rows
from tablepipe.sources.typed import read_typed_csv

BIG = 2**53  # ids that a double cannot tell apart


@query("dirty_csv_rejects", f"""
with dirty as (select *, o_orderkey % 7 = 0 as bad_id, o_orderkey % 11 = 0 as bad_price, o_orderkey % 13 = 0 as bad_date from orders),
rows as (select *, case when bad_id or bad_price or bad_date then concat_ws(',', case when bad_id then 'id' end,
  case when bad_price then 'price' end, case when bad_date then 'day' end) else 'loaded' end as reason from dirty)
select reason, count(*) as n, count(distinct case when bad_id then null else o_orderkey + {BIG} end) as ids,
  max(case when bad_id then null else o_orderkey + {BIG} end) as max_id from rows group by reason""")
def q_dirty_csv_rejects(spark, sf):
    """Orders exported with broken ids, prices and dates: what loads, and the rejects by reason."""
    k = F.col("o_orderkey")
    ident = (k + F.lit(BIG)).cast("string")
    export = table(spark, sf, "orders").select(
        F.when(k % 7 == 0, F.concat(F.lit("X"), ident)).otherwise(ident).alias("id"),
        F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.format_number("o_totalprice", 2)).alias("price"),
        F.when(k % 13 == 0, F.lit("nonsense")).otherwise(F.col("o_orderdate").cast("string")).alias("day"))
    path = scratch_path(spark, "dirty_orders")
    export.write.option("header", True).csv(path)
    rows = read_typed_csv(spark, path, types={"id": "bigint", "price": "double"}, ts_formats={"day": None}, on_bad="flag")
    bad = F.array_join("__bad", ",")
    return rows.groupBy(F.when(bad == "", "loaded").otherwise(bad).alias("reason")).agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.max("id").alias("max_id"))


@query("failed_reload", "select * from orders")
def q_failed_reload(spark, sf):
    """A table whose second load fails half-way: the first load's rows, untouched."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "reloaded")
    replace_path(orders, path)
    broken = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 0, F.raise_error(F.lit("broken row")))
                               .otherwise(F.col("o_orderstatus")))
    try:
        replace_path(broken, path)
    except Exception as e:  # noqa: BLE001 - the load must fail for this reason only
        if "broken row" not in str(e):
            raise
    return spark.read.parquet(path).select(*ORDERS_COLS)


@query("html_implied_ends", """
select o_custkey as customer, cast(o_orderkey as varchar) as "key", o_orderstatus as status, false as rejected
from orders where o_custkey % 10 <> 0
union all select distinct o_custkey, null, null, true from orders where o_custkey % 10 = 0""")
def q_html_implied_ends(spark, sf):
    """Pages of a customer's orders (at most a thousand order numbers a page) in a table without end
    tags, behind a table of another id; every tenth customer's pages lack the table and are rejected."""
    orders = table(spark, sf, "orders")
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("<td>"), F.col("o_orderstatus"))
    ident = F.when(F.col("o_custkey") % 10 == 0, "gone").otherwise("t")
    pages = orders.groupBy("o_custkey", F.expr("o_orderkey div 1000")).agg(F.array_join(F.collect_list(row), "").alias("rows")).select(
        F.col("o_custkey").alias("customer"),
        F.concat(F.lit("<p>Orders<p>of one customer<table id=other><tr><td>no</table><table id="), ident,
                 F.lit("><thead><tr><th>Key<th>Status<tbody>"), F.col("rows"), F.lit("</table><p>end")).alias("html"))
    got = html_rows(pages, "html", "t", keep=["customer"])
    ok = F.col("error").isNull()
    rows = got.where(~ok | (F.col("pos") > 0)).select(
        "customer", F.get("cells", F.lit(0)).alias("key"), F.get("cells", F.lit(1)).alias("status"), (~ok).alias("rejected"))
    return rows.distinct()  # a customer's rejected pages are one reject


@query("html_scoped_options", """
select n_regionkey as region, cast(n_nationkey as varchar) as value from nation where n_nationkey % 3 <> 0""")
def q_html_scoped_options(spark, sf):
    """One form per region with two lists of nations, no option closed: the values of the first list."""
    n = table(spark, sf, "nation")
    option = F.concat(F.lit("<option value="), F.col("n_nationkey").cast("string"), F.lit(">"), F.col("n_name"))
    ours = F.col("n_nationkey") % 3 != 0
    forms = n.groupBy(F.col("n_regionkey").alias("region")).agg(
        F.array_join(F.collect_list(F.when(ours, option)), "").alias("a"),
        F.array_join(F.collect_list(F.when(~ours, option)), "").alias("b"))
    page = F.concat(F.lit("<form><select id=first>"), "a", F.lit("</select><select id=second>"), "b", F.lit("</form>"))
    got = html_options(forms.select("region", page.alias("html")), "html", "first", keep=["region"])
    return got.where(F.col("error").isNull()).select("region", "value")
