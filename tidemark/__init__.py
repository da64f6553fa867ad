"""Tidemark: ingestion and change-data jobs on plain PySpark DataFrames and streams."""

__version__ = "0.1.0"
