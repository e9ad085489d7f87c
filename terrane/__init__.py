"""Landscape analytics for surveillance data, written as Spark DataFrame operators."""

__version__ = "0.1.0"
