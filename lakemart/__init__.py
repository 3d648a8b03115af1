"""Incremental data marts on PySpark: landing, watermarked reloads, upserts, star schemas."""

__version__ = "0.1.0"
