"""Registered queries over the driver tables, each with its DuckDB oracle.

``queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` maps the same names to SQL over the pre-registered views.
"""

from __future__ import annotations

from tablepipe.plans import catalog, dirty, ingest, job_runs, rows, schema, shape, stream, writes  # noqa: F401
from tablepipe.plans._base import REGISTRY, table


def queries() -> dict:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}


__all__ = ["queries", "oracle_sql", "table"]
