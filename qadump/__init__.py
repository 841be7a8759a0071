"""Batch analytics over community Q&A dumps, as plain Spark DataFrame jobs."""
