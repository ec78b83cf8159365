"""Registered queries over the driver tables, with the SQL they are checked against."""

from changeflow.workload import quality, raw, runs, state, steps, streams  # noqa: F401  (registration)
from changeflow.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
