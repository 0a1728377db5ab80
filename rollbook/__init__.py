"""Spark-native analytics for student-admission records."""

__version__ = "0.1.0"
