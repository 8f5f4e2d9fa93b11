"""Readers, writers and catalog helpers (CSV, parquet, tables, temp views)."""
