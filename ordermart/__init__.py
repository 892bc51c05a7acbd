"""Batch and incremental sales-order mart built from Spark DataFrame operations."""
