"""Sinks: file writers (CSV, JSON, Parquet, partitioned, dynamic overwrite,
append) and the JDBC publish step."""
