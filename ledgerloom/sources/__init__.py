"""Readers and writers on Spark's own formats."""
