"""Spark-native validation and feature engine for wagering records."""

__version__ = "0.1.0"
