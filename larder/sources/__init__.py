"""Readers and writers: the driver's parquet tables, M5-shaped CSV files,
feature Parquet and model persistence."""
