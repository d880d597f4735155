"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def require_columns(df: DataFrame, cols, what: str = "column") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what}(s) not found: {missing}; have {df.columns}")


def order_columns(order_by) -> list[Column]:
    """Order spec -> list of Columns (strings ascending, nulls last)."""
    out = []
    for o in as_list(order_by):
        out.append(F.col(o).asc_nulls_last() if isinstance(o, str) else o)
    return out


def quote_sql_string(text: str) -> str:
    """A SQL string literal with quotes and backslashes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_ident(name: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))
