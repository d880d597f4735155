"""Table contracts and the metadata-driven schema builder.

A :class:`TableContract` is a ``StructType`` plus keys and varchar limits.
Schema building works on DataFrames of metadata columns, so the schemas of
any number of datasets are built in one job; only the final ``StructType`` of
one dataset is assembled on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe._util import as_list
from tablepipe.operators.names import check_collisions, strip_name_col

INTEGER_TYPES = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


class TableContract:
    """Declared columns (order matters), unique keys and varchar limits.

    ``schema`` may be a ``StructType`` or DDL text; DDL is parsed on first use,
    when a session exists."""

    def __init__(self, schema, keys=(), varchar=None, name: str = ""):
        self._schema = schema
        self.keys = tuple(keys)
        self.varchar = dict(varchar or {})
        self.name = name

    @classmethod
    def from_ddl(cls, ddl: str, keys=(), varchar=None, name: str = "") -> "TableContract":
        return cls(ddl, keys, varchar, name)

    @property
    def schema(self) -> T.StructType:
        if not isinstance(self._schema, T.StructType):
            self._schema = T._parse_datatype_string(self._schema)
        return self._schema

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def ddl(self) -> str:
        parts = []
        for f in self.schema.fields:
            t = f"VARCHAR({self.varchar[f.name]})" if f.name in self.varchar else f.dataType.simpleString()
            parts.append(f"`{f.name}` {t}")
        return ", ".join(parts)

    def __repr__(self):
        return f"TableContract({self.name!r}, keys={self.keys})"


def check_contract(df: DataFrame, contract: TableContract) -> None:
    """Every declared column present with exactly the declared type, else
    ``AssertionError``; extra columns are not checked."""
    have = {f.name: f.dataType for f in df.schema.fields}
    bad = []
    for f in contract.schema.fields:
        if f.name not in have:
            bad.append(f"{f.name}: missing")
        elif have[f.name] != f.dataType:
            bad.append(f"{f.name}: expected {f.dataType.simpleString()}, got {have[f.name].simpleString()}")
    if bad:
        raise AssertionError("contract failed: " + "; ".join(bad))


def contract_report(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per declared column: ``(column_name, expected, actual, nulls, ok)``.

    ``nulls`` counts nulls in one aggregation (partial per task); an integer
    column holding a null fails, as an integer pandas column cannot hold one.
    Lazy: nothing runs until the report is read."""
    have = {f.name: f.dataType for f in df.schema.fields}
    counts = df.agg(*[
        (F.count(F.lit(1)) - F.count(F.col(f.name))).alias(f"n{i}")
        for i, f in enumerate(contract.schema.fields) if f.name in have
    ] or [F.count(F.lit(1)).alias("__rows")])
    rows = []
    for i, f in enumerate(contract.schema.fields):
        actual = have.get(f.name)
        nulls = F.col(f"n{i}") if actual is not None else F.lit(None).cast("bigint")
        ok = F.lit(actual == f.dataType)
        if isinstance(f.dataType, INTEGER_TYPES):
            ok = ok & (F.coalesce(nulls, F.lit(0)) == 0)
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("expected"),
            F.lit(actual.simpleString() if actual is not None else None).cast("string").alias("actual"),
            nulls.cast("bigint").alias("nulls"),
            ok.alias("ok")))
    return counts.select(F.inline(F.array(*rows)))


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types.
    A missing column is an error."""
    missing = [n for n in contract.names if n not in df.columns]
    if missing:
        raise KeyError(f"columns missing for contract {contract.name!r}: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields])


def varchar_violations(df: DataFrame, contract: TableContract, by=None) -> DataFrame:
    """Count values longer than their declared ``VARCHAR(n)`` (a warehouse load
    or a Spark varchar column would reject them), per group of ``by``."""
    by = as_list(by)
    aggs = [F.count_if(F.char_length(F.col(c)) > F.lit(n)).alias(f"{c}_too_long")
            for c, n in contract.varchar.items()]
    if not aggs:
        raise ValueError("contract declares no varchar column")
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# ---------------------------------------------------------------------------
# Portal type -> warehouse SQL type
# ---------------------------------------------------------------------------

# Portal type -> SQL type, default text width 1024.
BASE_SQL_TYPES = {
    "number": "DOUBLE PRECISION",
    "double": "DOUBLE PRECISION",
    "money": "DOUBLE PRECISION",
    "checkbox": "boolean",
    "text": "VARCHAR(1024)",
    "location": "VARCHAR(1024)",
    "multiline": "VARCHAR(1024)",
    "multipoint": "VARCHAR(1024)",
    "multipolygon": "VARCHAR(1024)",
    "polygon": "VARCHAR(1024)",
    "calendar_date": "TIMESTAMP",
    "point": "VARCHAR(1024)",
}
# The types a custom varchar length applies to.
VARCHAR_LEN_TYPES = ("point", "text", "location")
# System fields every portal extract carries, in this order.
SYSTEM_FIELDS = {"id": "VARCHAR(2048)", "created_at": "TIMESTAMP", "updated_at": "TIMESTAMP"}
WAREHOUSES = ("redshift", "postgres")


def sql_type_map(warehouse: str, varchar_len=None) -> dict:
    """Portal type -> SQL type for a warehouse kind; an unknown kind is an error."""
    kind = (warehouse or "").lower()
    if kind not in WAREHOUSES:
        raise ValueError(f"unknown warehouse kind {warehouse!r}; expected one of {WAREHOUSES}")
    out = dict(BASE_SQL_TYPES)
    if kind == "postgres":
        out["point"] = "POINT"
    if varchar_len is not None:
        for t in VARCHAR_LEN_TYPES:
            out[t] = f"VARCHAR({int(varchar_len)})"
    return out


def spark_type_of(sql_type: str) -> T.DataType:
    s = sql_type.upper()
    if s.startswith("DOUBLE"):
        return T.DoubleType()
    if s == "BOOLEAN":
        return T.BooleanType()
    if s.startswith("VARCHAR") or s == "POINT":
        return T.StringType()
    if s == "TIMESTAMP":
        return T.TimestampNTZType()
    raise ValueError(f"no Spark type for {sql_type!r}")


def _map_literal(d: dict) -> Column:
    pairs = []
    for k, v in d.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def map_types(columns: DataFrame, warehouse: str, varchar_len=None,
              type_col: str = "data_type") -> DataFrame:
    """Add ``sql_type`` (null for an unknown portal type) and ``is_point``.
    The type table is a literal map, so this is a projection, not a join."""
    m = sql_type_map(warehouse, varchar_len)
    sql = _map_literal(m)[F.col(type_col)]
    return columns.withColumns({"sql_type": sql, "is_point": F.coalesce(sql == F.lit("POINT"), F.lit(False))})


def unknown_types(mapped: DataFrame, type_col: str = "data_type") -> list[str]:
    """Distinct portal types that have no SQL type (all of them: one dataset's columns are the bound)."""
    rows = mapped.where(F.col("sql_type").isNull()).select(type_col).distinct().collect()
    return sorted(str(r[0]) for r in rows)


# ---------------------------------------------------------------------------
# Metadata documents -> column tables (T5), drift (U2, U3), merge
# ---------------------------------------------------------------------------

METADATA_SCHEMA = ("description string, rowsUpdatedAt bigint, "
                   "tableAuthor struct<screenName: string>, "
                   "columns array<struct<name: string, dataTypeName: string>>")


def metadata_columns(docs: DataFrame, doc_col: str = "doc", id_col: str = "dataset_id") -> DataFrame:
    """``(dataset_id, position, raw_name, name, data_type)`` per metadata column;
    ``name`` is the cleaned header (strip, lower, drop non-word characters)."""
    parsed = docs.select(F.col(id_col), F.from_json(F.col(doc_col), METADATA_SCHEMA).alias("m"))
    cols = parsed.select(id_col, F.posexplode("m.columns").alias("position", "c"))
    return cols.select(id_col, "position", F.col("c.name").alias("raw_name"),
                       strip_name_col(F.col("c.name")).alias("name"),
                       F.col("c.dataTypeName").alias("data_type"))


def schema_drift(meta_cols: DataFrame, data_cols: DataFrame, id_col: str = "dataset_id") -> DataFrame:
    """Metadata columns absent from the data (set difference per dataset)."""
    return meta_cols.join(data_cols.select(id_col, "name"), on=[id_col, "name"], how="left_anti")


def merge_system_fields(typed: DataFrame, id_col: str = "dataset_id",
                        datasets: DataFrame | None = None) -> DataFrame:
    """Add the system fields to every dataset: a system field's type wins over
    a dataset column of the same name, which keeps its position; new names are
    appended after the dataset's columns, in system order.

    Input ``(dataset_id, position, name, sql_type)``; output the same, with
    ``position`` renumbered 0.. per dataset. ``datasets`` lists every dataset
    id (default: those in ``typed``), so a dataset whose columns all drifted
    still gets its system fields. One aggregation per (dataset, name) and one
    window per dataset (column counts, not rows)."""
    from pyspark.sql import Window

    base = typed.select(id_col, F.col("position").cast("bigint").alias("position"),
                        "name", "sql_type", F.lit(0).alias("prio"))
    ids = (datasets if datasets is not None else typed).select(id_col).distinct()
    sys_rows = F.array(*[F.struct(F.lit(i).cast("bigint").alias("k"), F.lit(n).alias("name"),
                                  F.lit(t).alias("sql_type"))
                         for i, (n, t) in enumerate(SYSTEM_FIELDS.items())])
    system = (ids.select(id_col, F.inline(sys_rows))
              .select(id_col, (F.lit(1 << 40) + F.col("k")).alias("position"), "name", "sql_type",
                      F.lit(1).alias("prio")))
    both = base.unionByName(system)
    merged = both.groupBy(id_col, "name").agg(
        F.max_by("sql_type", "prio").alias("sql_type"), F.min("position").alias("pos"))
    w = Window.partitionBy(id_col).orderBy("pos")
    return merged.select(id_col, (F.row_number().over(w) - 1).alias("position"), "name", "sql_type")


@dataclass
class BuiltSchema:
    contract: TableContract
    column_order: list
    point_columns: list
    drifted: list


def build_schema(meta_cols: DataFrame, data_columns, warehouse: str, varchar_len=None,
                 id_col: str = "dataset_id") -> BuiltSchema:
    """Schema of ONE dataset from its metadata columns and the data's headers.

    Drifted columns (in metadata, not in data) are removed first, so an
    unknown type only fails when the column is really loaded; cleaned names
    that collide are an error; system fields are merged last."""
    spark = meta_cols.sparkSession
    data = spark.createDataFrame([(n,) for n in data_columns], "name string")
    ds = meta_cols.select(id_col).distinct().limit(2).collect()
    if len(ds) != 1:
        raise ValueError("build_schema takes the metadata of exactly one dataset")
    dsid = ds[0][0]
    data = data.select(F.lit(dsid).alias(id_col), "name")
    drifted = sorted(r[0] for r in schema_drift(meta_cols, data, id_col).select("name").collect())
    kept = meta_cols.join(data, on=[id_col, "name"], how="left_semi")
    rows = kept.orderBy("position").select("raw_name", "name", "data_type").collect()
    check_collisions([r.raw_name for r in rows], [r.name for r in rows])
    mapped = map_types(kept, warehouse, varchar_len)
    bad = unknown_types(mapped)
    if bad:
        raise KeyError(f"unknown portal types: {bad}")
    final = merge_system_fields(mapped.select(id_col, "position", "name", "sql_type"), id_col)
    cols = final.orderBy("position").select("name", "sql_type").collect()
    fields, varchar, points = [], {}, []
    for r in cols:
        fields.append(T.StructField(r.name, spark_type_of(r.sql_type), True))
        if r.sql_type.upper().startswith("VARCHAR("):
            varchar[r.name] = int(r.sql_type[8:-1])
        if r.sql_type == "POINT":
            points.append(r.name)
    contract = TableContract(T.StructType(fields), (), varchar, str(dsid))
    return BuiltSchema(contract, [r.name for r in cols], points, drifted)


def table_columns(contract: TableContract) -> list[dict]:
    """Column spec as ``[{"name", "sql_type"}]`` records (T4)."""
    out = []
    for f in contract.schema.fields:
        if f.name in contract.varchar:
            t = f"VARCHAR({contract.varchar[f.name]})"
        elif isinstance(f.dataType, T.DoubleType):
            t = "DOUBLE PRECISION"
        elif isinstance(f.dataType, T.BooleanType):
            t = "boolean"
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            t = "TIMESTAMP"
        else:
            t = f.dataType.simpleString()
        out.append({"name": f.name, "sql_type": t})
    return out


def schema_docs_from_tables(spark: SparkSession, tables: dict) -> DataFrame:
    """Portal-style metadata documents derived from tables' schemas:
    ``(dataset_id, doc)``, one per table, with portal types chosen from the
    Spark types (number, text, calendar_date, checkbox; anything else is
    reported as its Spark type name and so has no SQL type)."""
    rows = []
    for name, df in tables.items():
        cols = [{"name": f.name, "dataTypeName": portal_type_of(f.dataType)} for f in df.schema.fields]
        rows.append((name, cols))
    raw = spark.createDataFrame(rows, "dataset_id string, columns array<struct<name: string, dataTypeName: string>>")
    return raw.select("dataset_id", F.to_json(F.struct("columns")).alias("doc"))


def portal_type_of(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType,
                          T.FloatType, T.DecimalType)):
        return "number"
    if isinstance(dtype, T.StringType):
        return "text"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "calendar_date"
    if isinstance(dtype, T.BooleanType):
        return "checkbox"
    return dtype.simpleString()


def infer_types(df: DataFrame, cols=None, thousands: str = ",") -> DataFrame:
    """Type text columns the way a table reader does: blank text is null; a
    column whose every non-null value is an integer (thousands separators
    allowed) becomes ``bigint``, else all numbers -> ``double``, else it stays
    text. One global aggregation (partial per task) decides all columns."""
    cols = [c for c in (as_list(cols) or df.columns)
            if isinstance(df.schema[c].dataType, T.StringType)]
    if not cols:
        return df

    def clean(c):
        t = F.trim(F.col(f"`{c}`"))
        return F.when(t != F.lit(""), t)

    def digits(c):
        return F.replace(clean(c), F.lit(thousands), F.lit("")) if thousands else clean(c)

    aggs = []
    for i, c in enumerate(cols):
        present = clean(c).isNotNull()
        aggs += [F.count_if(present).alias(f"p{i}"),
                 F.count_if(present & digits(c).try_cast("bigint").isNull()).alias(f"l{i}"),
                 F.count_if(present & digits(c).try_cast("double").isNull()).alias(f"d{i}")]
    stats = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        if stats[f"p{i}"] > 0 and stats[f"l{i}"] == 0:
            out[c] = digits(c).try_cast("bigint")
        elif stats[f"p{i}"] > 0 and stats[f"d{i}"] == 0:
            out[c] = digits(c).try_cast("double")
        else:
            out[c] = clean(c)
    return df.withColumns(out)


def enforce_varchar(df: DataFrame, contract: TableContract) -> DataFrame:
    """Fail the job on the first value longer than its declared ``VARCHAR(n)``,
    as a warehouse load would. The check rides in the load's own projection:
    no extra pass over the data."""
    guards = {}
    for c, n in contract.varchar.items():
        if c in df.columns:
            col = F.col(f"`{c}`")
            msg = F.concat(F.lit(f"value longer than VARCHAR({n}) in column {c}: "), F.substring(col, 1, 40))
            guards[c] = F.when(F.char_length(col) > F.lit(n), F.raise_error(msg)).otherwise(col)
    return df.withColumns(guards) if guards else df


def enforce_not_null(df: DataFrame, cols) -> DataFrame:
    """Fail the job on the first null in ``cols`` (integer columns of a
    contract). The guard rides in the write's own projection: the failed job
    commits no output, and no separate pass over the data is needed."""
    guards = {}
    for c in as_list(cols):
        col = F.col(f"`{c}`")
        guards[c] = F.when(col.isNull(), F.raise_error(F.lit(f"null in integer column {c}"))).otherwise(col)
    return df.withColumns(guards) if guards else df


def integer_columns(contract: TableContract) -> list[str]:
    return [f.name for f in contract.schema.fields if isinstance(f.dataType, INTEGER_TYPES)]
