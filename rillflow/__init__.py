"""Spark-first analytics for river networks and valley bottoms."""

__version__ = "0.1.0"
