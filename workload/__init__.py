"""Registered queries, each with its own DuckDB statement where SQL can express it."""
