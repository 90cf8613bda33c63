"""Tallyloom: DataFrame and Structured Streaming operators for event analytics."""

__version__ = "0.1.0"
