"""Spark-first analytics for catalogues of time-based media and the text around them."""

__version__ = "0.1.0"
