"""Importing this module registers every query."""

from workload import comparison, dashboards, intake, preparation, statistics, storage, untidy  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
