"""Spark-first engine for sampling-based audit fieldwork."""
