"""311 extract: requests of the last six months minus one category, as a CSV
published over the previous extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablepipe.operators.filters import recent_exclude
from tablepipe.operators.sinks import export_single_csv

# Fixed value: the category left out of the published layer.
EXCLUDED_TYPE = "Homeless Encampment"


def extract(requests: DataFrame, as_of=None, months: int = 6, excluded: str = EXCLUDED_TYPE) -> DataFrame:
    """``createddate > as_of - 6 months AND requesttype != excluded``; rows with
    a null date or type are dropped (SQL rules)."""
    return recent_exclude(requests, "createddate", months=months, as_of=as_of,
                          col="requesttype", value=excluded)


def run(spark: SparkSession, source: str, out_path: str, as_of=None,
        excluded: str = EXCLUDED_TYPE) -> None:
    requests = spark.table(source) if "/" not in source else spark.read.parquet(source)
    export_single_csv(extract(requests, as_of, excluded=excluded), out_path)
