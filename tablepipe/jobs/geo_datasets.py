"""Geo datasets: a manifest of distributions -> one table per dataset from
its preferred format; all failures reported together at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablepipe.sources.manifest import FORMAT_PRIORITY, load_manifest

MANIFEST_SCHEMA = "table_name string, item_id string, format string, url string"


def single_item_manifest(spark: SparkSession, table_name: str, distributions) -> DataFrame:
    """A manifest for one explicitly named item, overriding the catalog."""
    return spark.createDataFrame([(table_name, None, f, u) for f, u in distributions], MANIFEST_SCHEMA)


def run(spark: SparkSession, manifest: DataFrame | None = None, schema: str = "geo",
        priority=FORMAT_PRIORITY, item: tuple | None = None):
    """Load from ``item = (table_name, [(format, url), ...])`` when given (it
    overrides the manifest), else from ``manifest``; neither is an error."""
    if item is not None:
        manifest = single_item_manifest(spark, item[0], item[1])
    if manifest is None:
        raise ValueError("provide a manifest, or one item with its distributions")
    return load_manifest(spark, manifest, schema, priority=priority)
