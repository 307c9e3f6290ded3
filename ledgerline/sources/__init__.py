"""Readers for landed source files (CSV, JSON, JSON envelopes, Parquet)."""
