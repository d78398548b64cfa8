"""Spark-native corpus vocabulary analytics."""

__version__ = "0.1.0"
