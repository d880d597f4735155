"""Schemas of JSON rows (T1-T5): which keys the rows of a dataset have and the
narrowest portal type that holds every value of a key.

Each value has a kind; the kinds of a key are gathered as bits by one aggregate
(partial per task, one row per dataset and key moves), and the bits name the type:
one kind is its own type, numbers of several kinds the widest of them, any other
mixture text. Nulls fit every type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe._util import as_list
from tablepipe.operators.names import strip_name_col

# Portal types a JSON value can stand for, one bit each; null has no bit.
KINDS = ("checkbox", "number", "double", "money", "calendar_date", "point", "multipoint", "multiline", "polygon",
         "multipolygon", "location", "text")
BIT = {k: 1 << i for i, k in enumerate(KINDS)}
# The type names of GeoJSON geometries.
GEOMETRIES = {"Point": "point", "MultiPoint": "multipoint", "MultiLineString": "multiline", "Polygon": "polygon",
              "MultiPolygon": "multipolygon"}
_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
_MONEY = r"^-?\$-?\d{1,3}(,?\d{3})*(\.\d+)?$"


def value_kind(value: Column) -> Column:
    """The bit of a variant value's kind; 0 for JSON null."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    shape = F.try_variant_get(value, "$.type", "string")
    place = F.try_variant_get(value, "$.latitude", "string").isNotNull() & F.try_variant_get(value, "$.longitude", "string").isNotNull()
    out = (F.when(kind == "VOID", 0).when(kind == "BOOLEAN", BIT["checkbox"]).when(kind == "BIGINT", BIT["number"])
           .when(kind.startswith("DECIMAL") & kind.endswith(",0)"), BIT["number"])
           .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), BIT["double"])
           .when((kind == "STRING") & text.rlike(_DATE), BIT["calendar_date"])
           .when((kind == "STRING") & text.rlike(_MONEY), BIT["money"]))
    for name, portal in GEOMETRIES.items():
        out = out.when(kind.startswith("OBJECT") & (shape == name), BIT[portal])
    return out.when(kind.startswith("OBJECT") & place, BIT["location"]).otherwise(BIT["text"])


def portal_type(kinds: Column) -> Column:
    """The portal type of a set of kinds (bits); no kind at all is text."""
    out = None
    for name, bit in BIT.items():
        out = F.when(kinds == bit, name) if out is None else out.when(kinds == bit, name)
    numbers = BIT["number"] | BIT["double"]
    money = numbers | BIT["money"]
    some = kinds != 0
    return (out.when(some & (kinds.bitwiseAND(F.lit(numbers)) == kinds), "double")
            .when(some & (kinds.bitwiseAND(F.lit(money)) == kinds), "money").otherwise("text"))


def fields(rows: DataFrame, json_col: str, by=()) -> DataFrame:
    """(by..., raw_name, kinds, rows, spot): one row per key of the JSON objects of ``json_col``;
    ``spot`` is the key's first place in any object. A row that is no JSON object fails the query;
    a null row holds no keys."""
    by = as_list(by)
    parsed = rows.select(*by, F.parse_json(F.col(json_col)).alias("__v"), F.json_object_keys(F.col(json_col)).alias("__k"))
    bad = F.raise_error(F.concat(F.lit("no JSON object: "), F.substring(F.to_json("__v"), 1, 60)))
    keys = F.when(F.col("__v").isNotNull() & F.col("__k").isNull(), bad.cast("array<string>")).otherwise(F.col("__k"))
    each = parsed.select(*by, F.col("__v").cast("map<string,variant>").alias("__m"), F.posexplode(keys).alias("spot", "raw_name"))
    each = each.select(*by, "spot", "raw_name", value_kind(F.col("__m")[F.col("raw_name")]).alias("kind"))
    return each.groupBy(*by, "raw_name").agg(F.bit_or("kind").alias("kinds"), F.count("*").alias("rows"), F.min("spot").alias("spot"))


def metadata_documents(found: DataFrame, id_col: str) -> DataFrame:
    """(dataset_id, doc): a portal metadata document per dataset from the rows of ``fields``; the
    columns stand by their first place in the rows, then by name."""
    column = F.struct("spot", F.col("raw_name").alias("name"), portal_type(F.col("kinds")).alias("dataTypeName"))
    listed = found.groupBy(F.col(id_col).alias("dataset_id")).agg(F.array_sort(F.collect_list(column)).alias("c"))
    columns = F.transform("c", lambda x: F.struct(x["name"].alias("name"), x["dataTypeName"].alias("dataTypeName")))
    return listed.select("dataset_id", F.to_json(F.struct(columns.alias("columns"))).alias("doc"))


def data_headers(found: DataFrame, id_col: str) -> DataFrame:
    """(dataset_id, name): the cleaned headers of the data, with the portal's row id under its table name."""
    cleaned = strip_name_col(F.col("raw_name"))
    name = F.when(F.col("raw_name") == "sid", "id").otherwise(cleaned)
    return found.select(F.col(id_col).alias("dataset_id"), name.alias("name")).distinct()


# Spark types of the kinds when rows become columns
_SPARK = {"checkbox": "boolean", "number": "bigint", "double": "double"}


def struct_type(rows: DataFrame, json_col: str) -> T.StructType:
    """The struct of the rows' keys in order: booleans, integers and floats as such, all else text
    (nested values keep their JSON)."""
    found = fields(rows, json_col).orderBy("spot", "raw_name").select("raw_name", portal_type(F.col("kinds")).alias("kind")).collect()
    return T.StructType([T.StructField(r["raw_name"], T._parse_datatype_string(_SPARK.get(r["kind"], "string"))) for r in found])


def numbered(found: DataFrame, id_col: str) -> DataFrame:
    """``found`` with ``position``, the column's number in its dataset."""
    return found.withColumn("position", F.row_number().over(Window.partitionBy(id_col).orderBy("spot", "raw_name")) - 1)
