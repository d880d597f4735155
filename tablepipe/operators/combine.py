"""Tagging, unions, preference choice and period work lists."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepipe._util import as_col, as_list, require_columns


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns (e.g. year, month, line of a fetched piece)."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Append by column name; a column missing from a piece becomes null."""
    dfs = [d for d in dfs if d is not None]
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def rank_expr(col, ranks) -> "F.Column":
    """Position of ``col`` in the preference list (0 = best); null if unlisted."""
    pairs = []
    for i, r in enumerate(as_list(ranks)):
        pairs += [F.lit(r), F.lit(i)]
    return F.create_map(*pairs)[as_col(col)]


def choose_by_priority(df: DataFrame, keys, rank_col: str, ranks, tie_break=()) -> DataFrame:
    """Per key, the row whose ``rank_col`` comes first in ``ranks`` (e.g.
    shapefile, then geojson, then csv); ties go to the smallest ``tie_break``.
    Rows whose value is not in ``ranks`` are never chosen.

    The preference list is a literal map, so there is no join at all; the
    choice is a ``min_by`` aggregate, folded map-side before the shuffle."""
    keys = as_list(keys)
    require_columns(df, keys + [rank_col])
    rank = rank_expr(rank_col, ranks)
    order = F.struct(rank.alias("r"), *[as_col(t) for t in as_list(tie_break)])
    value_cols = [c for c in df.columns if c not in keys]
    ranked = df.where(rank.isNotNull())
    best = ranked.groupBy(*keys).agg(
        F.min_by(F.struct(*value_cols), order).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in value_cols])


def period_worklist(years: DataFrame, lines: DataFrame, as_of=None,
                    year_col: str = "year", line_col: str = "line") -> DataFrame:
    """Every (year, month, line) to fetch, skipping future periods: later years,
    and the current month onwards of the current year.

    ``years`` and ``lines`` are one-column frames of option values (text).
    Years are taken as integers from 1 to the year of ``as_of``, which bounds
    them to a calendar's worth; they are gathered as one sorted array, and each
    line row generates its periods from it - no join, no product operator; the
    output is spread like the lines. Text like ``'02024'`` is the year 2024."""
    as_of = as_of or dt.date.today()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of[:10])
    y = F.col(year_col).cast("string").try_cast("int")
    valid = sorted(r[0] for r in years.select(y.alias("y")).where(F.col("y").between(1, as_of.year)).distinct().collect())
    ln = lines.select(F.col(line_col).cast("string").alias("line")).distinct()
    if not valid:
        return ln.select(F.lit("").alias("year"), F.lit("").alias("month"), "line").limit(0)
    periods = ln.select("line", F.explode(F.array(*map(F.lit, valid))).alias("y"))
    last = F.when(F.col("y") < as_of.year, F.lit(12)).otherwise(F.lit(as_of.month - 1))
    months = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    months = F.transform(months, lambda m: m.cast("string"))
    return periods.select(F.col("y").cast("string").alias("year"), F.explode(months).alias("month"), "line")
