"""tablepipe: DataFrame operators for paged, typed public-data ingestion.

Sub-packages: ``operators`` (reshape, filters, contracts, sinks, catalog),
``sources`` (typed CSV/JSON, paged Data Source, HTML UDTFs, manifests and
GeoJSON), ``functions`` (column functions), ``plans`` (the registered queries
over the driver tables), ``streaming`` (incremental ingest) and ``jobs`` (the
six pipelines built from the operators).
"""

__version__ = "0.1.0"
