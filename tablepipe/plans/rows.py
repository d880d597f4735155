"""Row-level queries: filters, time, names, text and HTML extraction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablepipe.functions.text import contains_text, point_text
from tablepipe.functions.timeops import to_wall_clock
from tablepipe.operators.catalog import UPLOAD_METADATA_PATHS, extract_paths
from tablepipe.operators.combine import choose_by_priority, period_worklist, tag, union_by_name
from tablepipe.operators.contract import TableContract, varchar_violations
from tablepipe.operators.filters import (
    cast_columns,
    day_slice,
    drop_null_keys,
    drop_strict,
    exclude_keep_nulls,
    exclude_sql,
    guard_empty,
    lookup_one,
    recent_exclude,
    sample_rows,
    split_rejects,
)
from tablepipe.operators.names import rename_snake, rename_strip
from tablepipe.plans._base import ORDERS_COLS, query, table
from tablepipe.sources.html import attr_values, html_rows

AS_OF = dt.date(2001, 8, 1)
PRIORITY_NULLED = "NULLIF(o_orderpriority, '1-URGENT')"
ORDERS_NULLED_SQL = ", ".join(ORDERS_COLS[:-1]) + f", {PRIORITY_NULLED} AS o_orderpriority"


def _orders_nulled(spark, sf):
    return table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")))


@query("recent_exclude",
       "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 6 MONTH "
       "AND o_orderpriority <> '5-LOW'")
def q_recent_exclude(spark, sf):
    return recent_exclude(table(spark, sf, "orders"), "o_orderdate", months=6, as_of=AS_OF,
                          col="o_orderpriority", value="5-LOW")


@query("exclude_keep_nulls",
       f"SELECT {ORDERS_NULLED_SQL} FROM orders WHERE {PRIORITY_NULLED} IS DISTINCT FROM '5-LOW'")
def q_exclude_keep_nulls(spark, sf):
    return exclude_keep_nulls(_orders_nulled(spark, sf), "o_orderpriority", "5-LOW")


@query("exclude_sql", f"SELECT {ORDERS_NULLED_SQL} FROM orders WHERE {PRIORITY_NULLED} <> '5-LOW'")
def q_exclude_sql(spark, sf):
    return exclude_sql(_orders_nulled(spark, sf), "o_orderpriority", "5-LOW")


@query("day_slice_pst",
       "SELECT * FROM events WHERE CAST(ts - INTERVAL 8 HOUR AS DATE) = DATE '2024-01-15'")
def q_day_slice_pst(spark, sf):
    return day_slice(table(spark, sf, "events"), "ts", "2024-01-15", zone="-08:00")


@query("tz_convert",
       "SELECT o_orderkey, o_orderdate, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE "
       "'America/Los_Angeles' AS o_orderdate_local FROM orders")
def q_tz_convert(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderdate",
                    to_wall_clock("o_orderdate", "America/Los_Angeles").alias("o_orderdate_local"))


@query("drop_null_cast",
       "SELECT event_id, ts, CAST(CAST(NULLIF(user_id, 8) AS DOUBLE) AS BIGINT) AS user_id, "
       "event_type, value FROM events WHERE NULLIF(user_id, 8) IS NOT NULL")
def q_drop_null_cast(spark, sf):
    ev = table(spark, sf, "events").withColumn(
        "user_id", F.nullif(F.col("user_id"), F.lit(8)).cast("double"))
    ev = drop_null_keys(ev, ["user_id"])
    ev = cast_columns(ev, {"user_id": "bigint"})
    return drop_strict(ev, "props")


@query("period_worklist",
       "SELECT CAST(y AS VARCHAR) AS year, CAST(m AS VARCHAR) AS month, line FROM "
       "(SELECT DISTINCT year(o_orderdate) AS y FROM orders) "
       "CROSS JOIN (SELECT unnest(range(1, 13)) AS m) "
       "CROSS JOIN (SELECT DISTINCT p_type AS line FROM part) "
       "WHERE y < 2001 OR (y = 2001 AND m < 8)")
def q_period_worklist(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("year"))
    lines = table(spark, sf, "part").select(F.col("p_type").alias("line"))
    return period_worklist(years, lines, as_of=AS_OF)


@query("union_tagged",
       "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, "
       "c_mktsegment AS mktsegment, 'customer' AS source FROM customer UNION ALL "
       "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 'supplier' FROM supplier")
def q_union_tagged(spark, sf):
    """Pieces aligned by column name, each tagged with its source; the
    supplier piece has no segment column, which comes back as null. Each
    table is scanned once."""
    cust = table(spark, sf, "customer").toDF("key", "name", "nationkey", "acctbal", "mktsegment")
    supp = table(spark, sf, "supplier").toDF("key", "name", "nationkey", "acctbal")
    return union_by_name(tag(cust, source="customer"), tag(supp, source="supplier"))


@query("metadata_paths",
       "SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS raw, "
       "json_extract_string(props, '$.k') AS display FROM events UNION ALL "
       "SELECT event_id, 'k.x' AS name, json_extract_string(props, '$.k.x') AS raw, "
       "json_extract_string(props, '$.k.x') AS display FROM events")
def q_metadata_paths(spark, sf):
    return extract_paths(table(spark, sf, "events"), "props", {"k": "k", "k.x": "k.x"},
                         id_col="event_id")


@query("epoch_format",
       "WITH d AS (SELECT user_id, 'user ' || user_id AS descr, "
       "CAST(floor(epoch(max(ts))) AS BIGINT) AS e, max(ts) AS m FROM events GROUP BY user_id) "
       "SELECT user_id, 'Description' AS name, descr AS raw, descr AS display FROM d UNION ALL "
       "SELECT user_id, 'Data updated at', CAST(e AS VARCHAR), strftime(m, '%Y-%m-%d %H:%M') FROM d "
       "UNION ALL SELECT user_id, 'Data provided by', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM d")
def q_epoch_format(spark, sf):
    """Per-user metadata documents (description, last update as epoch seconds,
    no author) captured the portal way: raw values plus a display form."""
    from tablepipe.functions.timeops import epoch_seconds

    ev = table(spark, sf, "events")
    docs = ev.groupBy("user_id").agg(F.max("ts").alias("m")).select(
        "user_id",
        F.to_json(F.struct(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("description"),
                           epoch_seconds("m").alias("rowsUpdatedAt"))).alias("doc"))
    return extract_paths(docs, "doc", UPLOAD_METADATA_PATHS, id_col="user_id", zone="UTC")


@query("point_text",
       "SELECT c_custkey, '(' || c_custkey || ', ' || c_nationkey || ')' AS point FROM customer")
def q_point_text(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.concat(F.lit("POINT ("), F.col("c_custkey").cast("string"), F.lit(" "),
                   F.col("c_nationkey").cast("string"), F.lit(")"))
    return c.select("c_custkey", point_text(raw).alias("point"))


@query("rename_snake",
       "SELECT c_custkey AS cust_key, c_name AS name, c_nationkey AS nation_key, "
       "c_acctbal AS acct_bal, c_mktsegment AS mkt_segment FROM customer")
def q_rename_snake(spark, sf):
    c = table(spark, sf, "customer").toDF("Cust Key", " Name ", "Nation (Key)", "Acct Bal", "Mkt Segment")
    return rename_snake(c)


@query("rename_strip",
       "SELECT c_custkey AS id, c_name AS customername, c_nationkey AS nationkey, "
       "c_acctbal AS acctbal, c_mktsegment AS residence FROM customer")
def q_rename_strip(spark, sf):
    c = table(spark, sf, "customer").toDF(" SID ", "Customer Name!", "Nation#Key", "Acct. Bal ($)", "Residence")
    return rename_strip(c)


@query("html_list_values",
       "SELECT page_id, value FROM (SELECT page_id, unnest(regexp_extract_all(html, "
       "'<a\\b[^>]*?\\bhref=\"([^\"]*)\"', 1)) AS value FROM pages) WHERE value <> '/The'")
def q_html_list_values(spark, sf):
    p = table(spark, sf, "pages")
    vals = p.select("page_id", F.explode(attr_values("html", "a", "href")).alias("value"))
    return vals.where(F.col("value") != "/The")


@query("html_option_values",
       "SELECT page_id, value FROM (SELECT page_id, unnest(regexp_extract_all(html, "
       "'<a\\b[^>]*?\\bhref=\"([^\"]*)\"', 1)) AS value FROM pages) WHERE value <> '/The'")
def q_html_option_values(spark, sf):
    """The same list through the HTML parser UDTF (element-scoped path of S11)."""
    from tablepipe.sources.html import html_options

    vals = html_options(table(spark, sf, "pages"), "html", None, tag="a", attr="href", keep=["page_id"])
    return vals.where(F.col("error").isNull() & (F.col("value") != "/The")).select("page_id", "value")


@query("html_table_rows",
       "SELECT page_id, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS text FROM "
       "(SELECT page_id, regexp_extract_all(html, '<li>(?:<a [^>]*>)?([^<]*)', 1) AS arr FROM pages)")
def q_html_table_rows(spark, sf):
    rows = html_rows(table(spark, sf, "pages"), "html", element_id=None, row_tag="li",
                     cell_tags="", keep=["page_id"])
    return rows.select("page_id", "pos", F.col("cells")[0].alias("text"))


@query("page_reject",
       "SELECT page_id, contains(html, 'lang=\"fr\"') AS rejected FROM pages")
def q_page_reject(spark, sf):
    _, _, tagged = split_rejects(table(spark, sf, "pages"), contains_text("html", 'lang="fr"'))
    return tagged.select("page_id", "rejected")


@query("format_priority",
       "SELECT user_id, event_id, ts, event_type, value, props FROM (SELECT *, row_number() OVER "
       "(PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 "
       "WHEN 'click' THEN 2 END, ts) AS rn FROM events WHERE event_type IN ('purchase', 'signup', 'click')) "
       "WHERE rn = 1")
def q_format_priority(spark, sf):
    return choose_by_priority(table(spark, sf, "events"), "user_id", "event_type",
                              ["purchase", "signup", "click"], tie_break=["ts"])


@query("varchar_guard",
       "SELECT lang, count(*) FILTER (WHERE length(text) > 1024) AS text_too_long "
       "FROM documents GROUP BY lang")
def q_varchar_guard(spark, sf):
    contract = TableContract.from_ddl("doc_id bigint, text string, lang string",
                                      varchar={"text": 1024}, name="documents")
    return varchar_violations(table(spark, sf, "documents"), contract, by="lang")


@query("empty_guard", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def q_empty_guard(spark, sf):
    """An empty slice passes the ``skip`` guard and fails the other, which makes the load
    fall back to a slice with rows."""
    orders = table(spark, sf, "orders")
    empty = guard_empty(orders.where(F.col("o_orderkey") < 0), policy="skip")
    try:
        return guard_empty(empty, policy="fail", what="today's orders")
    except ValueError:
        return guard_empty(orders.where(F.col("o_orderstatus") == "F"), policy="fail")


@query("sample_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def q_sample_rows(spark, sf):
    return sample_rows(table(spark, sf, "customer"), 5, order_by="c_custkey")


@query("lookup_one", "SELECT * FROM nation WHERE n_nationkey = 7 LIMIT 1")
def q_lookup_one(spark, sf):
    return lookup_one(table(spark, sf, "nation"), F.col("n_nationkey") == 7, what="nation")


@query("parquet_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def q_parquet_scan(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").where(
        F.col("c_acctbal") > 0)
