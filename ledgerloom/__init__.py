"""Spark-native analytics for retail transaction ledgers."""

__version__ = "0.1.0"
