"""Typed CSV and JSON scans.

CSV is read as text and typed by JVM expressions: Spark's CSV reader has no
thousands option and an ANSI cast of ``'1,234.5'`` fails, so numbers lose
their separators first; named columns stay text and keep leading zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe.functions.text import is_bad, parse_integer, parse_number, parsed_or_fail
from tablepipe.functions.timeops import parse_ts

_INTEGER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (T.FloatType, T.DoubleType)


def _as_struct(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(schema)


def read_typed_csv(spark: SparkSession, path, types: dict | None = None,
                   ts_formats: dict | None = None, thousands: str = ",",
                   order_col: str | None = None, on_bad: str = "fail",
                   bad_col: str = "__bad", **options) -> DataFrame:
    """CSV with a header; every column arrives as text, then the columns in
    ``types`` (header name -> Spark type) are typed: numbers through
    :func:`parse_number`, timestamps through ``ts_formats`` (or ISO), anything
    else by a safe cast. Unlisted columns stay text. ``order_col`` adds the
    arrival order (file, split, position) for "first row wins" rules.

    ``on_bad`` says what a cell with text that does not parse does: ``fail`` the
    query (the default), or ``flag`` it: the value is null and ``bad_col`` lists
    the names of the row's bad columns, for a rejects output."""
    if on_bad not in ("fail", "flag"):
        raise ValueError("on_bad must be 'fail' or 'flag'")
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .options(**options).csv(path))
    if order_col:
        from tablepipe.operators.sinks import with_file_order

        raw = with_file_order(raw, order_col)
    types, ts_formats = dict(types or {}), dict(ts_formats or {})
    for c in list(types) + list(ts_formats):
        if c not in raw.columns:
            raise KeyError(f"column {c!r} not in CSV header {raw.columns}")
    out = {}
    for c, t in types.items():
        dt = T._parse_datatype_string(t) if isinstance(t, str) else t
        if isinstance(dt, _INTEGER) or isinstance(dt, T.DecimalType):
            out[c] = parse_integer(F.col(f"`{c}`"), dt.simpleString(), thousands)
        elif isinstance(dt, _NUMERIC):
            out[c] = parse_number(F.col(f"`{c}`"), thousands=thousands).try_cast(dt)
        elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            out[c] = parse_ts(F.col(f"`{c}`"), ts_formats.get(c)).cast(dt)
        elif isinstance(dt, T.StringType):
            out[c] = F.col(f"`{c}`")
        else:
            out[c] = F.col(f"`{c}`").try_cast(dt)
    for c, fmt in ts_formats.items():
        if c not in types:
            out[c] = parse_ts(F.col(f"`{c}`"), fmt)
    if on_bad == "flag":
        bad = [F.when(is_bad(F.col(f"`{c}`"), v), F.lit(c)) for c, v in out.items()]
        return raw.withColumns({**out, bad_col: F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")})
    return raw.withColumns({c: parsed_or_fail(F.col(f"`{c}`"), v, c) for c, v in out.items()}) if out else raw


def read_typed_json(spark: SparkSession, path, schema, multi_line: bool = True,
                    order_col: str | None = None, stage: str | None = None, **options) -> DataFrame:
    """JSON with a declared schema: one JSON array per file (``multi_line``) or JSON
    lines. A number read into a string column keeps its text (``12`` ->
    ``'12'``); a missing field is null. An array file is read by many tasks
    (:func:`~tablepipe.sources.json_array.parsed_elements`) and each record is parsed once, into
    a table at ``stage`` where that is given (JSON lines need none).

    A record that is no JSON, or a value that does not fit its type, fails the
    query. With ``mode="PERMISSIVE"`` and a ``_corrupt_record string`` column in
    the schema such records are kept there, for a rejects output. An array that
    is cut off, or holds anything but objects, fails in either mode."""
    options = {"mode": "FAILFAST", **options}
    if multi_line:
        from tablepipe.sources.json_array import parsed_elements

        wanted = _as_struct(schema)
        rows = parsed_elements(spark, path, lambda text: F.from_json(text, wanted, options), order_col=order_col, stage=stage)
        kept = [order_col] if order_col else []
        return rows.select(*[F.col("element")[f.name].alias(f.name) for f in wanted.fields], *kept)
    df = spark.read.schema(_as_struct(schema)).options(**options).json(path)
    if order_col:
        from tablepipe.operators.sinks import with_file_order

        df = with_file_order(df, order_col)
    return df
