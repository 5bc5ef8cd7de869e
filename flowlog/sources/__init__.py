"""Readers and writers: Parquet tables, CSV, XES."""
