"""Registered queries, one family per module."""

from checks import q_changes, q_datasets, q_functions, q_loads, q_outputs, q_relational, q_sources  # noqa: F401
from checks.registry import QUERIES, run  # noqa: F401
