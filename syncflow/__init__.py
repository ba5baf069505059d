"""Incremental table synchronisation on Spark."""
