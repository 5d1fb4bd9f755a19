"""Spark-first analytics for curating, scoring and gating text corpora."""
