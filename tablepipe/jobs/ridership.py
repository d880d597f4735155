"""Rail/bus ridership: a work list of (year, month, line) from the form page,
fetched result pages parsed into one table.

Pages are rows ``(year, month, line, html)``; a page saying the data is not
available yet goes to the rejects output, the others are parsed by the HTML
UDTF on the executors, the "Total" row is removed (rows with no day type are
kept) and the pieces are aligned by column name. Blank cells are null and
number columns are typed as numbers (thousands separators allowed), as a
table reader does. The table is replaced and a run-dated snapshot partition
is written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.functions.text import contains_text
from tablepipe.operators.combine import period_worklist
from tablepipe.operators.contract import infer_types
from tablepipe.operators.filters import exclude_keep_nulls, split_rejects
from tablepipe.operators.sinks import staged, write_snapshot, write_table
from tablepipe.sources.html import html_options, html_rows

# Element ids of the ridership form and result page.
LINES_ID = "ContentPlaceHolder1_lbLines"
YEARS_ID = "ContentPlaceHolder1_ddlYear"
TABLE_ID = "ContentPlaceHolder1_ASPxRoundPanel2_gvRidership"
# The "no data" marker, the day-type column and its total row.
NOT_AVAILABLE = "Data not available yet"
DAY_TYPE = "Day Type"
TOTAL = "Total"


def form_options(form: DataFrame, html_col: str = "html"):
    """``(lines, years)`` option values of the form page(s); ``All`` is not a line."""
    lines = html_options(form, html_col, LINES_ID).where(F.col("error").isNull())
    lines = lines.select(F.col("value").alias("line")).where(F.col("line") != "All")
    years = html_options(form, html_col, YEARS_ID).where(F.col("error").isNull())
    return lines, years.select(F.col("value").alias("year"))


def worklist(spark: SparkSession, form: DataFrame, as_of=None) -> DataFrame:
    lines, years = form_options(form)
    return period_worklist(years, lines, as_of=as_of or dt.date.today())


def _distinct_names(keys):
    """Header names that are distinct without regard to case and clash with no key:
    a blank one is its place, a repeat gets ``.1``, ``.2`` as a table reader numbers them."""
    named = F.transform("header", lambda h, i: F.when(F.trim(h) == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(h))
    low = F.concat(F.array(*[F.lit(k.lower()) for k in keys]), F.transform(named, F.lower))

    def number(h, i):
        before = F.size(F.filter(F.slice(low, 1, i + len(keys)), lambda x: x == F.lower(h)))
        return F.when(before > 0, F.concat(h, F.lit("."), before.cast("string"))).otherwise(h)

    return F.transform(named, number)


def parse_pages(pages: DataFrame, keys=("year", "month", "line")):
    """``(table, rejects)``: rows of every page's table with named columns, and
    the pages that said "not available" or had no table, with the reason."""
    keys = list(keys)
    ok, not_avail, _ = split_rejects(pages, contains_text("html", NOT_AVAILABLE))
    # parse once: everything below reads the written rows
    rows = staged(html_rows(ok, "html", TABLE_ID, keep=keys))
    failed = rows.where(F.col("error").isNotNull()).select(*keys, F.col("error").alias("reason"))
    rows = rows.where(F.col("error").isNull()).withColumn("header", _distinct_names(keys))
    no_day = rows.where((F.col("pos") == 0) & ~F.array_contains("header", DAY_TYPE)).select(
        *keys, F.lit(f"no column {DAY_TYPE!r}").alias("reason"))
    rows = rows.where(F.array_contains("header", DAY_TYPE))
    header = rows.where(F.col("pos") == 0).select("header")
    body = rows.where(F.col("pos") > 0)
    body = body.select(*keys, "pos", F.map_from_arrays(
        F.slice("header", 1, F.least(F.size("header"), F.size("cells"))),
        F.slice("cells", 1, F.least(F.size("header"), F.size("cells")))).alias("m"))
    # the output's columns: the tables' distinct header names
    names = [r[0] for r in header.select(F.explode("header")).distinct().collect()]
    ordered = sorted(names, key=lambda n: (n != DAY_TYPE, n))
    blank_null = {n: F.nullif(F.trim(F.col("m")[n]), F.lit("")) for n in ordered}
    table = body.select(*keys, *[blank_null[n].alias(n) for n in ordered])
    if DAY_TYPE in ordered:
        table = exclude_keep_nulls(table, DAY_TYPE, TOTAL)
    table = infer_types(table, [n for n in ordered if n != DAY_TYPE])
    rejects = not_avail.select(*keys, F.lit(NOT_AVAILABLE).alias("reason")).unionByName(failed).unionByName(no_day)
    return table, rejects


def run(spark: SparkSession, pages: DataFrame, table_name: str, snapshot_root: str | None = None,
        run_date=None):
    table, rejects = parse_pages(pages)
    write_table(table, table_name, existing="drop")
    if snapshot_root:
        day = run_date or dt.date.today()
        write_snapshot(spark.table(table_name).withColumn("snapshot_date", F.lit(day)),
                       snapshot_root, partition_col="snapshot_date", skip_empty=False)
    return rejects
