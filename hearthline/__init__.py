"""Spark-first analytics engine for semi-structured public-record text."""

__version__ = "0.1.0"
