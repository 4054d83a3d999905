"""Spark-first analytics engine for batches of panoramic images."""
