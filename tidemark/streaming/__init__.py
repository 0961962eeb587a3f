"""Structured Streaming forms of ingestion, change application, quality split and gold refresh."""
