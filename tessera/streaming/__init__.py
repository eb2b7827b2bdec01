"""Incremental linkage."""
