"""Scans: the landed parquet tables and the raw landing files (CSV, XML, JSON, manifests)."""
