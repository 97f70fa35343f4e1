"""Append-only storage for RAW events and GOLD snapshots (parquet folders)."""
