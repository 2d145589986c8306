"""Scans, incremental slices and sinks."""
