"""Spark-first analytics for long-read structure data, with corpus operators beside it."""

__version__ = "0.1.0"
