"""Customer-analytics lakehouse operators on plain PySpark DataFrames.

Sub-packages: ``functions`` (column expressions), ``sources`` (scans, sinks, fixtures), ``operators``
(DataFrame -> DataFrame building blocks), ``plans`` (dimensions, facts, aggregates, views, medallion run)
and ``streaming`` (Structured Streaming forms).
"""
