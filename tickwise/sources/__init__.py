"""Readers and writers (CSV, Parquet, JSON, metrics, model persistence)."""
