"""Incremental (micro-batch) ingestion."""
