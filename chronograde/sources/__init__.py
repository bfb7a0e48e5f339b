"""Readers and writers: landing folders, Parquet table store, derived test views."""
