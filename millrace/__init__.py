"""Spark-first analytics over a star schema plus text and event tables."""
