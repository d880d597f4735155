import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablepipe.sources import html
from tablepipe.sources.html import attr_values, html_options, html_rows, parse_options, parse_rows
from tablepipe.sources.manifest import load_manifest, read_geojson
from tablepipe.sources.paged import page_offsets, read_paged
from tablepipe.sources.typed import read_typed_csv, read_typed_json

TABLE_HTML = """<html><body><select id="ContentPlaceHolder1_lbLines"><option value="All">All</option>
<option value="801">801</option><option value="802">802</option></select>
<table id="other"><tr><td>x</td></tr></table>
<table id="T"><tr><th>Day Type</th><th>Avg Boardings</th></tr>
<tr><td>Weekday</td><td>1,234</td></tr><tr><td></td><td>5</td></tr><tr><td>Total</td><td>9</td></tr></table>
</body></html>"""


def test_html_parsers():
    rows = parse_rows(TABLE_HTML, "T")
    assert rows[0] == ["Day Type", "Avg Boardings"] and rows[3] == ["Total", "9"] and len(rows) == 4
    assert parse_options(TABLE_HTML, "ContentPlaceHolder1_lbLines") == ["All", "801", "802"]
    with pytest.raises(ValueError):
        parse_rows(TABLE_HTML, "missing")


def test_html_udtfs(spark):
    df = spark.createDataFrame([(1, TABLE_HTML), (2, "<p>no table</p>")], "page_id long, html string")
    rows = html_rows(df, "html", "T", keep=["page_id"]).collect()
    assert sum(1 for r in rows if r.page_id == 1) == 4
    assert [r.error for r in rows if r.page_id == 2][0].startswith("ValueError")
    opts = html_options(df.where("page_id = 1"), "html", "ContentPlaceHolder1_lbLines").collect()
    assert [r.value for r in opts] == ["All", "801", "802"]
    hrefs = df.select(F.explode(attr_values(F.lit('<a href="/x">x</a><a class="c" href="/y">'))).alias("v"))
    assert [r.v for r in hrefs.collect()][:2] == ["/x", "/y"]


def test_small_pages_share_a_batch(spark):
    """Pages are parsed by Arrow batches, not by a table function called for each."""
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, F.lit("<p>none")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("<table id=T><tr><td>k<tr><td>"), "id", F.lit("</table><select id=T><option value=1>"))).alias("html"))
    rows = html_rows(df, "html", "T", keep=["id"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert rows.columns == ["id", "pos", "cells", "header", "error"]
    got = rows.collect()
    bad = [i for i in range(300) if i % 3 == 0 or i % 50 == 1]
    assert sorted(r.id for r in got if r.error) == bad and all(r.pos is None and r.cells is None for r in got if r.error)
    assert sorted((r.id, r.pos, r.cells[0], r.header[0]) for r in got if not r.error) == sorted(
        x for i in range(300) if i not in bad for x in [(i, 0, "k", "k"), (i, 1, str(i), "k")])


_SOUP = st.lists(st.sampled_from(
    ["<p>", "<P class=x>", "</p >", "<table id=T>", '<table id="T" border>', "<TABLE ID=T>", "</table>", "<tr>", "<tr\n>", "</tr>", "<td>", "<td colspan=2>",
     "<td id=''>", "<td x='a>b'>", "</td>", "<th a=1 b>", "<tbody>", "<li>", "<ul>", "</ul>", "<option value=3>", "<select id=T>", "<br>", "<br/>",
     "<td/>", "<h1>", "a", " b ", "&amp;", "&lt", "<", ">", "< td>", "<!-- <td> -->", "<!x>", "<script>", "</script>", "<style>", "</style>", "<title>",
     "</title>", "<textarea>", "</textarea>", "<td x=\"<\">", '<td y="">', "</td z>", "</", "<td", "<a-b>", "<td =3>", "<td x=a/b>", "\x0b", "é"]),
    max_size=14).map("".join)


@settings(max_examples=1500, deadline=None)
@given(_SOUP, st.sampled_from(["T", None]))
def test_plain_pages_parse_alike(page, ident):
    def run(parse):
        try:
            return parse(page, ident)
        except ValueError as e:
            return str(e)

    got = run(parse_rows), run(parse_options)
    plain, html._plain = html._plain, lambda page: None
    try:
        assert got == (run(parse_rows), run(parse_options))
    finally:
        html._plain = plain


def test_typed_csv(spark, out):
    p = f"{out}/a.csv"
    with open(p, "w") as f:
        f.write('ID,Amount,When,Code\n1,"1,234.5",3/1/2024 1:02:03 PM,007\n2,bad,,010\n9007199254740993,,,x\n2.7,1,soon,y\n')
    options = dict(types={"ID": "bigint", "Amount": "double"}, ts_formats={"When": "M/d/yyyy h:mm:ss a"})
    with pytest.raises(Exception, match="unparseable value in"):
        read_typed_csv(spark, p, **options).collect()
    r = {x.Code: x for x in read_typed_csv(spark, p, on_bad="flag", **options).collect()}
    assert r["007"].Amount == 1234.5 and str(r["007"].When) == "2024-03-01 13:02:03"
    assert r["010"].Amount is None and r["010"].When is None and r["010"]["__bad"] == ["Amount"]
    assert r["x"].ID == 9007199254740993 and r["x"]["__bad"] == []
    assert r["y"].ID is None and r["y"]["__bad"] == ["ID", "When"]


def test_broken_json_fails(spark, out):
    with open(f"{out}/a.json", "w") as f:
        f.write('{"a": 1}\n{"a": \n{"a": "oops"}\n')
    with pytest.raises(Exception):
        read_typed_json(spark, f"{out}/a.json", "a bigint", multi_line=False).collect()
    kept = read_typed_json(spark, f"{out}/a.json", "a bigint, _corrupt_record string", multi_line=False, mode="PERMISSIVE")
    assert sorted((r.a, r._corrupt_record is None) for r in kept.collect() if r.a is not None) == [(1, True)]


def test_html_without_end_tags():
    from tablepipe.sources.html import parse_options, parse_rows

    page = ("<select id=a><option value=1>x<option value=2>y</select><select id=b><option value=3></select>"
            "<table id=t><thead><tr><th>A<th>B<tbody><tr><td>1<td colspan=2>2<tr><td>3<table><tr><td>in</table><td>4</table>"
            "<ul id=l><li>one<li>two</ul>")
    assert parse_options(page, "a") == ["1", "2"] and parse_options(page, "b") == ["3"]
    assert parse_rows(page, "t") == [["A", "B"], ["1", "2", "2"], ["3in", "4"]]
    assert parse_rows(page, "l", "li", ()) == [["one"], ["two"]]


def test_typed_json_array(spark, out):
    p = f"{out}/a.json"
    with open(p, "w") as f:
        json.dump([{"trip_id": 1.0, "run_name": 12, "scheduled_depart": "2024-07-01T07:30:00Z"},
                   {"trip_id": None, "run_name": "A"}], f)
    df = read_typed_json(spark, p, "trip_id double, run_name string, scheduled_depart timestamp, missing string")
    rows = df.collect()
    assert rows[0].run_name == "12" and rows[1].scheduled_depart is None and rows[0].missing is None


def test_page_plan():
    assert page_offsets(10_000, 1000, 2500) == [0, 1000, 2000, 3000]
    assert page_offsets(2000, 1000, 2000) == [0, 1000]
    assert page_offsets(0, 1000) == []
    with pytest.raises(ValueError):
        page_offsets(10, 5, 0)


class ListFetcher:
    """A portal page source over an in-memory list of rows (tests)."""

    def __init__(self, n: int):
        self.n = n

    def count(self):
        return self.n

    def fetch(self, offset, limit):
        rows = [[str(i), f"POINT ({i} {i + 1})", "x"] for i in range(offset, min(offset + limit, self.n))]
        return [[" SID ", "Geo Point!", "Other"]] + rows


@pytest.mark.parametrize("page", [1, 3, 7, 50])
def test_paged_equals_full(spark, page):
    df = read_paged(spark, "tests.test_sources:ListFetcher", ["id", "geopoint"], page_size=page,
                    fetcher_args={"n": 23})
    ids = sorted(int(r.id) for r in df.collect())
    assert ids == list(range(23))
    assert df.rdd.getNumPartitions() == math.ceil(23 / page)


def test_paged_size_limit(spark):
    df = read_paged(spark, "tests.test_sources:ListFetcher", ["id"], page_size=10, size_limit=25,
                    fetcher_args={"n": 1000})
    assert df.count() == 40


def test_geojson_collection_mixed(spark, out):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a", "n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": {"name": "b", "n": 2},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}
    p = f"{out}/fc.geojson"
    with open(p, "w") as f:
        json.dump(fc, f)
    df = read_geojson(spark, p, properties_schema="name string, n int")
    got = {r.name: (r.n, r.geometry_type) for r in df.collect()}
    assert got == {"a": (1, "Point"), "b": (2, "Polygon")}


def test_manifest_collects_failures(spark, out):
    good = f"{out}/good.csv"
    with open(good, "w") as f:
        f.write("a,b\n1,2\n")
    manifest = spark.createDataFrame([
        ("good_one", "i1", "csv", good), ("good_one", "i1", "kml", "nowhere"),
        ("broken_a", "i2", "csv", f"{out}/missing_a.csv"), ("broken_b", "i3", "geojson", f"{out}/missing_b"),
        ("shape_only", "i4", "shapefile", f"{out}/s.zip")],
        "table_name string, item_id string, format string, url string")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS geo_test LOCATION '{out}/geo'")
    with pytest.raises(RuntimeError) as e:
        load_manifest(spark, manifest, "geo_test")
    assert "broken_a" in str(e.value) and "broken_b" in str(e.value)
    assert "shape_only: no readable distribution" in str(e.value)
    assert spark.table("geo_test.good_one").count() == 1
    assert dict(spark.table("geo_test.good_one").dtypes) == {"a": "bigint", "b": "bigint"}


def test_read_html_files(spark, out):
    import os

    from tablepipe.sources.html import read_html_files

    os.makedirs(f"{out}/pages")
    for name, body in [("2023-1-801.html", "<p>a</p>\n<p>b</p>"), ("2023-12-802.html", "<p>c</p>")]:
        with open(f"{out}/pages/{name}", "w") as f:
            f.write(body)
    df = read_html_files(spark, f"{out}/pages", r"(\d{4})-(\d+)-(\w+)\.html", keys=["year", "month", "line"])
    got = sorted((r.year, r.month, r.line, r.html) for r in df.collect())
    assert got == [("2023", "1", "801", "<p>a</p>\n<p>b</p>"), ("2023", "12", "802", "<p>c</p>")]


def test_udtfs_from_sql(spark):
    from tablepipe.sources.html import register

    register(spark)
    spark.createDataFrame([(1, TABLE_HTML)], "page_id long, html string").createOrReplaceTempView("tp_pages")
    rows = spark.sql("SELECT p.page_id, r.pos, r.cells FROM tp_pages p, "
                     "LATERAL html_rows(p.html, 'T', 'tr', 'td,th') r").collect()
    assert [r.cells for r in rows][0] == ["Day Type", "Avg Boardings"] and len(rows) == 4
    opts = spark.sql("SELECT r.value FROM tp_pages p, "
                     "LATERAL html_options(p.html, 'ContentPlaceHolder1_lbLines', 'option', 'value') r").collect()
    assert [r.value for r in opts] == ["All", "801", "802"]


def test_geojson_properties_inferred(spark, out):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a", "n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": {"name": "b", "n": 2.5, "extra": True},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}}]}
    p = f"{out}/fc2.geojson"
    with open(p, "w") as f:
        json.dump(fc, f)
    df = read_geojson(spark, p)
    types = dict(df.dtypes)
    assert types["name"] == "string" and types["n"] == "double" and types["extra"] == "boolean"
    got = {r.name: (r.n, r.extra, r.geometry_type) for r in df.collect()}
    assert got == {"a": (1.0, None, "Point"), "b": (2.5, True, "MultiPolygon")}


def test_paged_with_spark_built_index(spark, out):
    from pyspark.sql import functions as F

    from tablepipe.sources.paged import build_page_index

    store = f"{out}/store"
    spark.range(0, 5000, 1, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")) \
        .orderBy("k").write.parquet(store)
    build_page_index(spark, store, f"{out}/index")
    df = read_paged(spark, "tablepipe.sources.paged:SortedParquetFetcher", ["k", "v"], page_size=700,
                    fetcher_args={"path": store, "index_path": f"{out}/index"})
    rows = sorted((int(r.k), int(r.v)) for r in df.collect())
    assert rows == [(i, 2 * i) for i in range(5000)] and df.rdd.getNumPartitions() == 8


def test_warehouse_arguments(spark):
    from tablepipe.sources.warehouse import read_warehouse

    with pytest.raises(ValueError, match="exactly one"):
        read_warehouse(spark, "jdbc:none", table="t", query="select 1")
    with pytest.raises(ValueError, match="exactly one"):
        read_warehouse(spark, "jdbc:none")


@pytest.mark.parametrize("rows", [0, 1, 6, 7, 8, 48, 49, 50, 1000])
@pytest.mark.parametrize("most", [None, 1, 5])
def test_frontier_finds_the_last_page(rows, most):
    from tablepipe.sources.paged import frontier

    probes = []

    def probe(at):
        probes.append(at)
        return at < rows

    pages = math.ceil(rows / 7)
    assert frontier(probe, 7, most) == (pages if most is None else min(pages, most))
    assert len(probes) <= 2 * math.log2(max(pages, 2)) + 3


def test_countless_source_is_a_task_a_page(spark, out):
    from pyspark.sql import functions as F

    from tablepipe.sources.paged import build_page_index

    spark.range(0, 5000, 1, 3).select(F.col("id").alias("k")).orderBy("k").write.parquet(f"{out}/store")
    build_page_index(spark, f"{out}/store", f"{out}/index")
    df = read_paged(spark, "tablepipe.sources.paged:CountlessFetcher", ["k"], page_size=300,
                    fetcher_args={"path": f"{out}/store", "index_path": f"{out}/index"})
    assert df.rdd.getNumPartitions() == 17 and sorted(int(r.k) for r in df.collect()) == list(range(5000))


def test_catalog_facts_come_from_footers(spark, out):
    from pyspark.sql import functions as F

    from tablepipe.operators.catalog import catalog_facts, table_facts

    spark.sql(f"CREATE DATABASE IF NOT EXISTS facts_test LOCATION '{out}/f'")
    df = spark.range(50).select("id", F.when(F.col("id") > 9, F.col("id") / 4).alias("x"), F.lit("t").alias("s"))
    df.write.saveAsTable("facts_test.plain")
    df.write.partitionBy("s").saveAsTable("facts_test.parted")
    plan = table_facts(spark, "facts_test", "plain")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan
    rows = {(r.table, r.column): (r.data_type, r.rows, r.nulls, r.min_value, r.max_value)
            for r in catalog_facts(spark, databases=["facts_test"]).collect()}
    for t in ("plain", "parted"):
        assert rows[t, "id"] == ("bigint", 50, 0, 0.0, 49.0) and rows[t, "x"] == ("double", 50, 10, 2.5, 12.25)
        assert rows[t, "s"] == ("string", 50, 0, None, None)
    spark.sql("DROP DATABASE facts_test CASCADE")
