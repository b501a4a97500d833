"""Importing this module registers the queries of the subpackage."""

from riskframe.llm import free_queries, native_queries
from riskframe.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "free_queries", "native_queries"]
