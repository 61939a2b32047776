"""Incremental ingest of the landing zone."""
