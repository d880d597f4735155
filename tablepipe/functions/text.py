"""Text column functions: number parsing, point rewrite, JSON paths, search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablepipe._util import as_col


def parse_number(col, thousands: str = ",", decimal: str = ".") -> Column:
    """Parse text such as ``'1,234.5'`` into a double; unparseable text gives null.

    Spark's CSV reader has no thousands option and a plain ANSI cast of
    ``'1,234.5'`` fails, so the separator is removed first.
    """
    c = F.trim(as_col(col))
    if thousands:
        c = F.replace(c, F.lit(thousands), F.lit(""))
    if decimal != ".":
        c = F.replace(c, F.lit(decimal), F.lit("."))
    return F.try_cast(c, "double") if hasattr(F, "try_cast") else c.try_cast("double")


def parse_integer(col, type_name: str = "bigint", thousands: str = ",") -> Column:
    """Parse text such as ``'1,234'`` straight into an integer type: ids above 2^53
    stay distinct, and ``'2.7'`` or other text gives null instead of a rounded value."""
    c = F.trim(as_col(col))
    if thousands:
        c = F.replace(c, F.lit(thousands), F.lit(""))
    return c.try_cast(type_name)


def is_bad(raw, parsed) -> Column:
    """Whether a cell holds text (not only blanks) that did not parse."""
    raw = as_col(raw)
    return raw.isNotNull() & (F.trim(raw) != "") & as_col(parsed).isNull()


def parsed_or_fail(raw, parsed, name: str) -> Column:
    """``parsed``, failing the query on the first cell that holds text but no value."""
    message = F.concat(F.lit(f"unparseable value in {name!r}: "), as_col(raw))
    return F.when(is_bad(raw, parsed), F.raise_error(message)).otherwise(as_col(parsed))


def point_text(col) -> Column:
    """Rewrite ``POINT (x y)`` into ``(x, y)``: drop ``'POINT '``, then every
    remaining space becomes ``', '`` (the two literal replacements of the portal
    extract, in that order)."""
    c = F.replace(as_col(col), F.lit("POINT "), F.lit(""))
    return F.replace(c, F.lit(" "), F.lit(", "))


def json_path(col, path: str) -> Column:
    """Value at a dotted path of a JSON document; a missing key or a step into a
    non-object gives null. ``'tableAuthor.screenName'`` -> ``$.tableAuthor.screenName``."""
    if not path:
        raise ValueError("empty path")
    return F.get_json_object(as_col(col), "$." + path)


def contains_text(col, needle: str) -> Column:
    """Substring test (``str.find(needle) != -1``); null text gives null."""
    return F.contains(as_col(col), F.lit(needle))
