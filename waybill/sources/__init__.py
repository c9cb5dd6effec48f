"""Declared schemas, table access, CSV ingestion and publishing."""
