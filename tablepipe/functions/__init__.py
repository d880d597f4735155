"""Column functions (return ``Column``), all built from JVM-side expressions."""

from tablepipe.functions.text import contains_text, json_path, parse_number, point_text
from tablepipe.functions.timeops import (
    day_bounds_utc,
    epoch_seconds,
    epoch_text,
    ntz_literal,
    parse_ts,
    to_wall_clock,
)

__all__ = [
    "contains_text",
    "day_bounds_utc",
    "epoch_seconds",
    "epoch_text",
    "json_path",
    "ntz_literal",
    "parse_number",
    "parse_ts",
    "point_text",
    "to_wall_clock",
]
