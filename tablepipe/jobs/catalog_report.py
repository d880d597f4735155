"""Catalog report: every schema -> table -> description, geometry and CRS,
without the census schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablepipe.operators.catalog import catalog_listing

# Fixed value: the census schema left out of the listing.
EXCLUDED = ("tiger",)


def run(spark: SparkSession, out_path: str | None = None, exclude=EXCLUDED, catalogs=None) -> DataFrame:
    """The listing of the given catalogs (e.g. two warehouses registered as
    Spark catalogs); default the current catalog."""
    listing = catalog_listing(spark, exclude=exclude, catalogs=catalogs)
    if out_path:
        listing.write.mode("overwrite").parquet(out_path)
    return listing
