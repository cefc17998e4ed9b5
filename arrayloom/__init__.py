"""Spark-native analytics over hierarchical array files and plain tables."""

__version__ = "0.1.0"
