"""Projections, filters and guards.

All filters are plain Catalyst predicates on raw columns so they reach the
parquet scan as ``PushedFilters``. Time windows are computed at plan time into
literal bounds for the same reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe._util import as_col, as_list, order_columns, require_columns
from tablepipe.functions.timeops import day_bounds_utc, ntz_literal


def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; a missing name is an error (Spark's own drop is silent)."""
    require_columns(df, cols)
    return df.drop(*cols)


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """Drop rows where any of ``keys`` is null."""
    keys = as_list(keys)
    require_columns(df, keys)
    return df.na.drop(how="any", subset=keys)


def cast_columns(df: DataFrame, types: dict) -> DataFrame:
    """Cast named columns in place; double -> bigint truncates (2.7 -> 2)."""
    require_columns(df, list(types))
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def exclude_keep_nulls(df: DataFrame, col, value) -> DataFrame:
    """Keep rows whose ``col`` is not ``value``; null rows are KEPT (pandas ``!=``)."""
    return df.where(~as_col(col).eqNullSafe(F.lit(value)))


def exclude_sql(df: DataFrame, col, value) -> DataFrame:
    """Keep rows whose ``col`` is not ``value``; null rows are DROPPED (SQL ``!=``)."""
    return df.where(as_col(col) != F.lit(value))


def months_before(as_of, months: int) -> Column:
    """``as_of - INTERVAL months MONTHS`` as a literal (end of month clamps:
    Aug 31 minus 6 months is Feb 29 in a leap year)."""
    return ntz_literal(as_of) - F.make_ym_interval(F.lit(0), F.lit(int(months)))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def recent_exclude(df: DataFrame, ts_col, months: int = 6, as_of=None,
                   col=None, value=None) -> DataFrame:
    """``ts > as_of - months AND col != value`` with SQL null rules (nulls out).

    ``as_of`` defaults to the current UTC time, fixed when the plan is built."""
    as_of = utc_now() if as_of is None else as_of
    cond = as_col(ts_col) > months_before(as_of, months)
    if col is not None:
        cond = cond & (as_col(col) != F.lit(value))
    return df.where(cond)


def day_slice(df: DataFrame, ts_col, day, zone: str = "-08:00") -> DataFrame:
    """Rows whose UTC wall-clock ``ts_col`` falls on local ``day`` in ``zone``.

    Written as a half-open range on the raw column so the scan prunes it.
    ``zone`` defaults to a fixed UTC-8, which is what a warehouse reads the
    'PST' abbreviation as; pass a region name for a DST-aware day."""
    lo, hi = day_bounds_utc(day, zone)
    c = as_col(ts_col)
    name = ts_col if isinstance(ts_col, str) else None
    if name is not None and isinstance(df.schema[name].dataType, T.TimestampType):
        # an instant column: compare with instants, not wall clocks
        utc = dt.timezone.utc
        return df.where((c >= F.lit(lo.replace(tzinfo=utc))) & (c < F.lit(hi.replace(tzinfo=utc))))
    return df.where((c >= ntz_literal(lo)) & (c < ntz_literal(hi)))


def split_rejects(df: DataFrame, predicate: Column, flag: str = "rejected"):
    """Tag rows matching ``predicate`` as rejected; returns ``(ok, rejects, tagged)``.

    Failed items go to a rejects output instead of vanishing. Write ``tagged``
    once (e.g. partitioned by the flag) to avoid scanning the input twice."""
    tagged = df.withColumn(flag, F.coalesce(predicate, F.lit(False)))
    return tagged.where(~F.col(flag)).drop(flag), tagged.where(F.col(flag)).drop(flag), tagged


def guard_empty(df: DataFrame, policy: str = "skip", what: str = "input") -> DataFrame:
    """Empty-input guard. ``skip`` returns the (empty) frame with its schema,
    ``fail`` raises. Costs one ``LIMIT 1`` probe, not a count."""
    if policy not in ("skip", "fail"):
        raise ValueError("policy must be 'skip' or 'fail'")
    if policy == "fail" and df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def sample_rows(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` they are repeatable (top-k per
    partition, then a merge of k rows per partition)."""
    if order_by is not None:
        return df.orderBy(*order_columns(order_by)).limit(n)
    return df.limit(n)


def lookup_one(df: DataFrame, predicate: Column, what: str = "element") -> DataFrame:
    """The first row matching ``predicate``; raises ``LookupError`` when none does."""
    hit = df.where(predicate).limit(1)
    if hit.isEmpty():
        raise LookupError(f"no {what} matches {predicate}")
    return hit


def select_order(df: DataFrame, order) -> DataFrame:
    """Select and reorder to a declared column order; a missing column is an error."""
    order = as_list(order)
    require_columns(df, order)
    return df.select(*order)
