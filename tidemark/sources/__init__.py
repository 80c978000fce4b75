"""Readers, sinks and the versioned Parquet table log."""
