"""Scans, extracts, sinks and the test-data entities."""
