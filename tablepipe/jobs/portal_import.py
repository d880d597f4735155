"""Portal import: metadata-driven schema, paged extract, typed load, metadata
capture and table comment.

1. a 5-row sample gives the data headers (empty dataset -> error);
2. the metadata document gives names and portal types: drifted columns (in
   metadata, not in data) are removed, types mapped for the warehouse kind,
   system fields merged;
3. the extract is read page by page by executor tasks, point columns are
   rewritten and every column is cast to its declared type in one projection;
4. the table is loaded, the metadata captured and the table commented.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.functions.text import point_text
from tablepipe.operators.catalog import UPLOAD_METADATA_PATHS, extract_paths, set_table_comment
from tablepipe.operators.contract import BuiltSchema, build_schema, enforce_varchar, metadata_columns
from tablepipe.operators.sinks import export_single_csv, write_table
from tablepipe.sources.paged import PAGE_SIZE, clean_header, load_fetcher, read_paged

# Fixed value: rows fetched to learn the data headers.
SAMPLE_ROWS = 5


def dated_name(dataset_id: str, kind: str, day=None) -> str:
    """``{id}_extract_{date}.csv`` / ``{id}_metadata_{date}.json``."""
    import datetime as dt

    ext = {"extract": "csv", "metadata": "json"}[kind]
    return f"{dataset_id}_{kind}_{(day or dt.date.today()).isoformat()}.{ext}"


@dataclass
class ImportResult:
    schema: BuiltSchema
    metadata: DataFrame


def sample_headers(fetcher: str, fetcher_args: dict) -> list[str]:
    """Cleaned headers from a 5-row sample; raises when the dataset is empty."""
    page = load_fetcher(fetcher, fetcher_args).fetch(0, SAMPLE_ROWS)
    if isinstance(page, list):
        header, n = (page[0] if page else []), max(len(page) - 1, 0)
    else:
        header, n = page.column_names, page.num_rows
    if n == 0:
        raise ValueError("no rows returned for the dataset")
    return [clean_header(h) for h in header]


def typed_extract(spark: SparkSession, built: BuiltSchema, fetcher: str, fetcher_args: dict,
                  page_size: int = PAGE_SIZE, size_limit=None) -> DataFrame:
    raw = read_paged(spark, fetcher, built.column_order, page_size=page_size, size_limit=size_limit,
                     fetcher_args=fetcher_args)
    cols = []
    for f in built.contract.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in built.point_columns:
            c = point_text(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return enforce_varchar(raw.select(*cols), built.contract)


def run(spark: SparkSession, dataset_id: str, fetcher: str, fetcher_args: dict, metadata_doc: str,
        table: str | None = None, warehouse: str = "redshift", varchar_len=None,
        page_size: int = PAGE_SIZE, size_limit=None, existing: str = "drop",
        metadata_path: str | None = None, extract_root: str | None = None) -> ImportResult:
    headers = sample_headers(fetcher, fetcher_args)
    docs = spark.createDataFrame([(dataset_id, metadata_doc)], "dataset_id string, doc string")
    built = build_schema(metadata_columns(docs), headers, warehouse, varchar_len)
    data = typed_extract(spark, built, fetcher, fetcher_args, page_size, size_limit)
    captured = extract_paths(docs, "doc", UPLOAD_METADATA_PATHS)
    if extract_root:  # dated CSV extract next to the table load
        export_single_csv(data, f"{extract_root.rstrip('/')}/{dated_name(dataset_id, 'extract')}")
    if table:
        write_table(data, table, existing=existing)
        descr = json.loads(metadata_doc).get("description")
        if descr is not None:
            set_table_comment(spark, table, descr)
    if metadata_path:
        docs.select("doc").write.mode("overwrite").text(
            f"{metadata_path.rstrip('/')}/{dated_name(dataset_id, 'metadata')}")  # raw JSON
        captured.write.mode("overwrite").parquet(metadata_path + "/fields")
    return ImportResult(built, captured)
