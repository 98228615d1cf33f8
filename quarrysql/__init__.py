"""Corpus operators and analytic query patterns for text-to-SQL data, as PySpark DataFrame jobs."""

__version__ = "0.1.0"
