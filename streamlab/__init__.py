"""Streaming-analytics operators written against the PySpark DataFrame API."""
