"""Sources and sinks: Parquet, CSV, Delta, Iceberg, in-memory DataFrames."""

from .readers import (  # noqa: F401
    append_partitioned_by_day,
    append_to_catalog_table,
    apply_endpoint_override,
    bucket_spec,
    check_columns,
    normalize_path,
    read_csv_with_rejects,
    read_source,
    write_bucketed,
    write_table,
)
