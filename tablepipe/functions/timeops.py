"""Time column functions.

Timestamps read from parquet here are ``timestamp_ntz`` holding UTC wall
clock. Everything below avoids the session zone unless asked for it, so the
results do not change with ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablepipe._util import as_col

_EPOCH_NTZ = "1970-01-01 00:00:00"
_OFFSET = re.compile(r"^([+-])(\d{2}):?(\d{2})$")


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal that does not depend on the session zone."""
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def parse_ts(col, fmt=None) -> Column:
    """Text -> ``timestamp_ntz``; unparseable text gives null. ``fmt`` may be a
    list of formats, tried in order (``None`` in the list means ISO text).

    ``to_timestamp_ntz`` reads the wall clock as written (no zone), but fails
    on bad text under ANSI; ``try_to_timestamp`` tolerates bad text but goes
    through the session zone, which moves wall clocks that fall in a DST gap.
    So the tolerant parse only decides validity and the zone-free parse gives
    the value."""
    c = as_col(col)
    if isinstance(fmt, (list, tuple)):
        return F.coalesce(*[parse_ts(c, f) for f in fmt])
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    if not _has_zone_field(fmt):
        # one tolerant parse, pinned to UTC (no DST gaps), read back as a wall clock
        inst = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(fmt + " xx"))
        return utc_wall(inst)
    ok = F.try_to_timestamp(c, F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(c, F.lit(fmt)))


def _has_zone_field(fmt: str) -> bool:
    """Whether a datetime pattern has a zone or offset field (outside quotes)."""
    unquoted = re.sub(r"'[^']*'", "", fmt)
    return any(ch in unquoted for ch in "XxZzOVv")


def us_datetime_text(col) -> Column:
    """``M/d/yyyy h:mm:ss AM`` text of a ``timestamp_ntz`` from its fields
    (``date_format`` would pass through the session zone)."""
    t = as_col(col)
    h = F.hour(t)

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    return F.concat(F.month(t).cast("string"), F.lit("/"), F.dayofmonth(t).cast("string"), F.lit("/"),
                    F.year(t).cast("string"), F.lit(" "), (((h + 11) % 12) + 1).cast("string"), F.lit(":"),
                    two(F.minute(t)), F.lit(":"), two(F.second(t)), F.lit(" "),
                    F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM")))


def to_wall_clock(col, zone: str, source_zone: str = "UTC") -> Column:
    """Wall clock in ``zone`` of a UTC wall-clock ``timestamp_ntz``.

    The instant is unchanged; only its rendering moves (US/Pacific rendering of
    a UTC time)."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), as_col(col).cast("timestamp_ntz"))


def epoch_seconds(col) -> Column:
    """Whole epoch seconds of a UTC wall-clock ``timestamp_ntz``."""
    return F.timestamp_diff("SECOND", ntz_literal(_EPOCH_NTZ), as_col(col).cast("timestamp_ntz"))


def epoch_text(col, zone: str | None = None, fmt: str = "yyyy-MM-dd HH:mm") -> Column:
    """Epoch seconds -> ``'YYYY-MM-DD HH:MM'``.

    ``zone=None`` renders in the session zone (the process-local zone of the
    original); otherwise in the named zone. A null epoch gives null instead of
    failing."""
    c = as_col(col).cast("bigint")
    if zone is None:
        return F.from_unixtime(c, fmt)
    wall_utc = F.timestamp_add("SECOND", c, ntz_literal(_EPOCH_NTZ))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall_utc)
    if fmt == "yyyy-MM-dd HH:mm":  # zone-free rendering of the wall clock
        return F.substring(local.cast("string"), 1, 16)
    return F.date_format(local, fmt)


def zone_info(zone: str) -> dt.tzinfo:
    """Named zone or fixed offset such as ``'-08:00'``.

    Abbreviations such as ``'PST'`` are refused: SQL warehouses read them as a
    fixed UTC-8 while Spark and DuckDB read them as Los Angeles with DST."""
    m = _OFFSET.match(zone)
    if m:
        sign = -1 if m.group(1) == "-" else 1
        delta = dt.timedelta(hours=int(m.group(2)), minutes=int(m.group(3)))
        return dt.timezone(sign * delta)
    if zone.upper() in {"PST", "PDT", "EST", "EDT", "CST", "CDT", "MST", "MDT"}:
        raise ValueError(f"ambiguous zone abbreviation {zone!r}; pass an offset or a region name")
    return ZoneInfo(zone)


def day_bounds_utc(day, zone: str) -> tuple[dt.datetime, dt.datetime]:
    """Half-open UTC wall-clock range ``[start, end)`` of the local ``day`` in ``zone``.

    Computed at plan time, so the day test becomes a plain range on the raw
    column and reaches the parquet scan as pushed filters."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    if isinstance(day, dt.datetime):
        day = day.date()
    tz = zone_info(zone)
    start = dt.datetime.combine(day, dt.time(), tzinfo=tz)
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), tzinfo=tz)
    utc = dt.timezone.utc
    return (start.astimezone(utc).replace(tzinfo=None), end.astimezone(utc).replace(tzinfo=None))


def utc_wall(col) -> Column:
    """UTC wall clock (``timestamp_ntz``) of an instant (``timestamp``) column,
    independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_col(col)), ntz_literal(_EPOCH_NTZ))


def local_date(col, zone: str) -> Column:
    """Local calendar date in ``zone`` of a UTC wall-clock timestamp."""
    tz = zone_info(zone)
    if isinstance(tz, dt.timezone):
        offset = tz.utcoffset(None)
        seconds = int(offset.total_seconds())
        return F.to_date(F.timestamp_add("SECOND", F.lit(seconds), as_col(col).cast("timestamp_ntz")))
    return F.to_date(to_wall_clock(col, zone))
