"""Sinks: parquet tables, day partitions, CSV reports."""
from martflow.sinks.warehouse import (  # noqa: F401
    export_csv,
    save_csv,
    save_day,
    save_partitioned,
    save_table,
    write_empty_day,
)
