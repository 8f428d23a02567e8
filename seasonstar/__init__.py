"""Seasonal time-series analytics on a star schema, written as PySpark DataFrame operators."""

__version__ = "0.1.0"
