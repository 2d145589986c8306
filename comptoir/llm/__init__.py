"""Operators for preparing training text: dedup, extraction, classification, tokenising, archives, search, packing."""
