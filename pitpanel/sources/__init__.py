"""Scans and sinks: explicit source schemas, readers, driver-table adapters,
month-partitioned Parquet writes."""
