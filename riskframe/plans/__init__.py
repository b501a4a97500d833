"""Registered queries; importing the package fills the registry."""

from riskframe.plans import drifting, evaluating, io_contracts, learning, profiling, selecting
from riskframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "drifting", "evaluating", "io_contracts", "learning", "profiling", "selecting"]
