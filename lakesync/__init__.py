"""Snapshot-versioned Parquet tables and incremental synchronisation on PySpark."""
