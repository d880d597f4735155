"""Sources: typed CSV/JSON scans, the paged Data Source, HTML UDTFs,
GeoJSON features and manifest-driven loads."""
