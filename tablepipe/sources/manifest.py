"""Manifest-driven loads and GeoJSON features.

A manifest is a DataFrame ``(table_name, item_id, format, url)`` - one row per
available distribution of a dataset. The preferred distribution per dataset
is chosen by :func:`choose_by_priority`; then each dataset is read and written
as a table. Failures are collected and reported together at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe._util import quote_ident
from tablepipe.operators.combine import choose_by_priority
from tablepipe.operators.infer import struct_type
from tablepipe.sources.json_array import parsed_elements

# Default format preference, best first.
FORMAT_PRIORITY = ("shapefile", "geojson", "csv")
# Formats this library reads; shapefile decoding is not built, so a preferred
# shapefile falls through to the next readable format.
READABLE = ("geojson", "csv", "parquet", "json")
FEATURE_LINE_SCHEMA = "type string, properties string, geometry string"


def read_geojson(spark: SparkSession, path, properties_schema=None, kind: str = "collection") -> DataFrame:
    """Features as rows: property columns plus ``geometry`` (GeoJSON text) and
    ``geometry_type``.

    ``kind='collection'`` reads FeatureCollection documents, each by many tasks
    (the elements of its ``features`` array); ``kind='seq'`` reads
    newline-delimited features. Nested objects declared as strings keep their
    JSON text, so mixed geometry types never break schema inference. Without
    ``properties_schema`` it is inferred from all features."""
    if kind == "collection":
        feats = parsed_elements(spark, path, lambda text: F.from_json(text, FEATURE_LINE_SCHEMA, {"mode": "FAILFAST"}),
                                key="features").select("element.*")
    elif kind == "seq":
        feats = spark.read.schema(FEATURE_LINE_SCHEMA).json(path)
    else:
        raise ValueError("kind must be 'collection' or 'seq'")
    feats = feats.where(F.col("type") == "Feature")
    if properties_schema is None:
        properties_schema = struct_type(feats, "properties")
    parsed = feats.select(F.from_json("properties", properties_schema).alias("p"), "geometry")
    return parsed.select("p.*", "geometry", F.get_json_object("geometry", "$.type").alias("geometry_type"))


def _features(df: DataFrame, geometry_col: str, property_cols):
    props = property_cols or [c for c in df.columns if c != geometry_col]
    return F.format_string('{"type":"Feature","properties":%s,"geometry":%s}', F.to_json(F.struct(*props)), F.col(geometry_col))


def write_geojson_seq(df: DataFrame, path: str, geometry_col: str = "geometry",
                      property_cols=None) -> None:
    """Newline-delimited GeoJSON features; ``geometry_col`` holds GeoJSON text."""
    df.select(_features(df, geometry_col, property_cols).alias("value")).write.mode("overwrite").text(path)


def write_geojson_collection(df: DataFrame, path: str, geometry_col: str = "geometry", property_cols=None) -> None:
    """One FeatureCollection file; its features are written by parallel tasks."""
    from tablepipe.operators.sinks import single_file

    lines = df.select(F.concat(F.lit(","), _features(df, geometry_col, property_cols)).alias("value"))
    single_file(lines.write.format("text"), df.sparkSession, path, head='{"type":"FeatureCollection","features":[', tail="]}\n", skip=1)


def choose_distributions(manifest: DataFrame, priority=FORMAT_PRIORITY) -> DataFrame:
    """The best-ranked distribution per dataset; unlisted formats never win."""
    return choose_by_priority(manifest, ["table_name"], "format", priority, tie_break=["url"])


def read_distribution(spark: SparkSession, fmt: str, url: str) -> DataFrame:
    if fmt == "geojson":
        return read_geojson(spark, url)
    if fmt == "csv":  # typed like a table reader: blanks null, number columns numeric
        from tablepipe.operators.contract import infer_types

        return infer_types(spark.read.option("header", True).csv(url))
    if fmt in ("parquet", "json"):
        return spark.read.format(fmt).load(url)
    raise ValueError(f"no reader for format {fmt!r}")


RESULT_SCHEMA = "table_name string, format string, ok boolean, error string"


def load_datasets(spark: SparkSession, manifest: DataFrame, schema: str, priority=FORMAT_PRIORITY, parallel: int = 4) -> DataFrame:
    """Replace one table per dataset from its preferred distribution; one row per dataset:
    ``(table_name, format, ok, error)``.

    Every dataset is attempted, ``parallel`` at a time. Each load is a job of its own with its
    own staged switch, so a dataset that fails keeps the rows it had and holds up no other.
    The driver holds a catalog's worth of names."""
    from concurrent.futures import ThreadPoolExecutor

    from tablepipe.operators.sinks import replace_table

    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_ident(schema)}")
    readable = [f for f in priority if f in READABLE]
    chosen = choose_distributions(manifest, readable).select("table_name", "format", "url")
    rows = manifest.select("table_name").distinct().join(chosen, "table_name", "left").orderBy("table_name").collect()

    def load(row):
        if row.format is None:
            return row.table_name, None, False, f"no readable distribution (readable: {', '.join(readable)})"
        try:
            replace_table(read_distribution(spark, row.format, row.url), f"{schema}.{row.table_name}")
            return row.table_name, row.format, True, None
        except Exception as e:  # noqa: BLE001 - a dataset's failure is its result
            return row.table_name, row.format, False, str(e).splitlines()[0] if str(e) else type(e).__name__

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return spark.createDataFrame(list(pool.map(load, rows)), RESULT_SCHEMA)


def load_manifest(spark: SparkSession, manifest: DataFrame, schema: str, priority=FORMAT_PRIORITY, parallel: int = 4) -> DataFrame:
    """:func:`load_datasets`, raising once all datasets were attempted if any did not load."""
    results = load_datasets(spark, manifest, schema, priority, parallel)
    bad = results.where(~F.col("ok")).orderBy("table_name").collect()
    if bad:
        raise RuntimeError(f"{len(bad)} dataset(s) not loaded: " + "; ".join(f"{r.table_name}: {r.error}" for r in bad))
    return results
