"""Incremental file streams."""
