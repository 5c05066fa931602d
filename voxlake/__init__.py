"""Spark-native social-listening analytics: bronze to gold as DataFrame functions."""

__version__ = "0.1.0"
