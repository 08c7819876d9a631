"""Incremental ingestion of landed answers."""
