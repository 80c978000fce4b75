"""Incremental warehouse operators as plain PySpark DataFrame functions."""
