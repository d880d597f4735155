"""DataFrame operators: reshape, filters, combine, names, contracts, sinks, catalog."""

from tablepipe.operators.catalog import (
    catalog_listing,
    ensure_table,
    extract_paths,
    set_table_comment,
)
from tablepipe.operators.combine import choose_by_priority, period_worklist, tag, union_by_name
from tablepipe.operators.contract import (
    TableContract,
    build_schema,
    check_contract,
    conform,
    contract_report,
    enforce_varchar,
    infer_types,
    map_types,
    merge_system_fields,
    metadata_columns,
    schema_drift,
    sql_type_map,
    varchar_violations,
)
from tablepipe.operators.filters import (
    cast_columns,
    day_slice,
    drop_null_keys,
    drop_strict,
    exclude_keep_nulls,
    exclude_sql,
    guard_empty,
    lookup_one,
    recent_exclude,
    sample_rows,
    select_order,
    split_rejects,
)
from tablepipe.operators.names import rename_snake, rename_strip
from tablepipe.operators.reshape import (
    first_nonnull,
    measure_pivot,
    measure_pivot_join,
    melt,
    pivot_duplicates,
)
from tablepipe.operators.sinks import (
    append_ignore_conflicts,
    check_unique,
    dedup_first,
    export_csv,
    plan_append,
    rows_to_append,
    truncate_and_load,
    write_snapshot,
    write_table,
)

__all__ = [n for n in dir() if not n.startswith("_") and n not in ("catalog", "combine", "contract",
                                                                    "filters", "names", "reshape", "sinks")]
