"""Spark-first analytics for maintaining a reference database across releases."""
