"""Tidemark: medallion event analytics as plain PySpark DataFrame functions."""
