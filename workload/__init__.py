"""Queries over the driver's tables, each with an equal SQL text for DuckDB."""
