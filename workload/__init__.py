"""Test-table inputs, registered queries and their reference SQL."""

from workload import observability, retail, sinks  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
