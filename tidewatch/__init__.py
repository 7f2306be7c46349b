"""Streaming-analytics operators on PySpark DataFrames and Structured Streaming."""
