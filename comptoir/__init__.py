"""Retail stock, point-of-sale and expense analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
