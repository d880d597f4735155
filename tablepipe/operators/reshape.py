"""Long-to-wide reshape.

The original builds one row per key as ``groupby.first`` joined to a
``pivot``. Here the same rows come out of a single ``groupBy`` with conditional
aggregates: one hash exchange on the key with map-side partial aggregation,
instead of three exchanges for aggregate + pivot + join. A hot key is folded
map-side before the shuffle, so its size does not reach one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe._util import as_col, as_list, require_columns


def _order_expr(order_by) -> Column:
    cols = [as_col(c) for c in as_list(order_by)]
    if not cols:
        raise ValueError("order_by is required: a table has no row order, so 'first' needs one")
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def first_nonnull_expr(col, order: Column) -> Column:
    """First non-null value by ``order`` (rows where the value is null are skipped)."""
    c = as_col(col)
    return F.min_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), order))


def first_nonnull(df: DataFrame, keys, cols, order_by) -> DataFrame:
    """Per key, the first non-null value of each column in ``order_by`` order.

    Rows with a null key are dropped, as a pandas group-by does."""
    keys, cols = as_list(keys), as_list(cols)
    require_columns(df, keys + [c for c in cols if isinstance(c, str)])
    order = _order_expr(order_by)
    return df.where(_all_not_null(keys)).groupBy(*keys).agg(*[first_nonnull_expr(c, order).alias(c) for c in cols])


def _all_not_null(keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def measure_pivot(df: DataFrame, keys, name_col: str, value_col: str, measures,
                  attributes=(), order_by=None, on_duplicate: str = "raise",
                  names: dict | None = None, on_unknown: str = "ignore") -> DataFrame:
    """One row per key from one row per (key, measure).

    * ``measures`` is the declared list of measure names (no extra job to find
      them); each becomes a column, null where the pair is absent.
    * ``attributes`` take their first non-null value per key in ``order_by``
      order.
    * ``on_duplicate='raise'`` fails the query when a (key, measure) pair
      repeats, as a pandas pivot does; ``'first'`` keeps the first by
      ``order_by``.
    * ``names`` maps a measure to its output column name (default: itself).
    * ``on_unknown='raise'`` fails the query on a value under a measure that is
      not declared (counted in the same aggregate); ``'ignore'`` leaves it out.
    """
    if on_duplicate not in ("raise", "first"):
        raise ValueError("on_duplicate must be 'raise' or 'first'")
    if on_unknown not in ("raise", "ignore"):
        raise ValueError("on_unknown must be 'raise' or 'ignore'")
    keys, measures, attributes = as_list(keys), as_list(measures), as_list(attributes)
    require_columns(df, keys + [name_col, value_col] + attributes)
    names = names or {}
    order = _order_expr(order_by) if (attributes or on_duplicate == "first") else None
    name, value = F.col(name_col), F.col(value_col)

    aggs, finals = [], [F.col(k) for k in keys]
    for a in attributes:
        aggs.append(first_nonnull_expr(a, order).alias(a))
        finals.append(F.col(a))
    for i, m in enumerate(measures):
        out = names.get(m, m)
        hit = name == F.lit(m)
        if on_duplicate == "first":
            aggs.append(F.min_by(F.when(hit, value), F.when(hit, order)).alias(out))
            finals.append(F.col(out))
        else:
            v, n = f"__v{i}", f"__n{i}"
            aggs.append(F.max(F.when(hit, value)).alias(v))
            aggs.append(F.count_if(hit).alias(n))
            msg = F.concat(F.lit(f"duplicate (key, measure) for measure {m!r} at key "),
                           F.to_json(F.struct(*[F.col(k) for k in keys])))
            finals.append(F.when(F.col(n) > 1, F.raise_error(msg)).otherwise(F.col(v)).alias(out))
    if on_unknown == "raise":
        stranger = F.when(~F.coalesce(name.isin(measures), F.lit(False)) & value.isNotNull(), F.coalesce(name, F.lit("null")))
        aggs.append(F.max(stranger).alias("__stranger"))
        first = finals[0]
        finals[0] = F.when(F.col("__stranger").isNotNull(), F.raise_error(F.concat(
            F.lit("undeclared measure: "), F.col("__stranger")))).otherwise(first).alias(keys[0])
    grouped = df.where(_all_not_null(keys)).groupBy(*keys).agg(*aggs)
    return grouped.select(*finals)


def measure_pivot_join(df: DataFrame, keys, name_col: str, value_col: str, measures,
                       attributes=(), order_by=None, names: dict | None = None) -> DataFrame:
    """The original's form: first-per-key attributes joined to a pivot.

    Kept as a cross-check of :func:`measure_pivot`; it costs three exchanges
    instead of one and keeps one of a duplicated pair silently."""
    keys, measures = as_list(keys), as_list(measures)
    names = names or {}
    piv = (df.where(_all_not_null(keys)).groupBy(*keys).pivot(name_col, measures)
           .agg(F.max(value_col)))
    piv = piv.select(*keys, *[F.col(f"`{m}`").alias(names.get(m, m)) for m in measures])
    if not as_list(attributes):
        return piv
    attrs = first_nonnull(df, keys, attributes, order_by)
    return attrs.join(piv, on=keys, how="inner")


def pivot_duplicates(df: DataFrame, keys, name_col: str) -> DataFrame:
    """The (key, measure) pairs that would make the pivot fail, with their count."""
    keys = as_list(keys)
    return (df.groupBy(*keys, name_col).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def melt(df: DataFrame, ids, measures: dict, name_col: str = "measure",
         value_col: str = "value", pos_col: str | None = None) -> DataFrame:
    """Wide -> long with ``stack``: one row per (id, measure). ``measures`` maps a
    measure name to a column or expression of a common type."""
    ids = as_list(ids)
    parts = []
    for i, (m, expr) in enumerate(measures.items()):
        e = expr if isinstance(expr, str) else None
        if e is None:
            raise TypeError("measure expressions must be SQL text")
        parts.append((i, m, e))
    fields = ", ".join(
        (f"{i}, " if pos_col else "") + f"'{m}', {e}" for i, m, e in parts)
    cols = ((f"{pos_col}, " if pos_col else "") + f"{name_col}, {value_col}")
    return df.select(*ids, F.expr(f"stack({len(parts)}, {fields}) AS ({cols})"))
