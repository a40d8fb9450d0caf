"""Batch and streaming analytics for incremental data pipelines, on PySpark."""
