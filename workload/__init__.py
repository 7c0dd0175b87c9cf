"""The queries registered for checking and benchmarking."""

from workload import catalog_queries, feed_queries, parity_queries, plan_queries, scalar_queries  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
