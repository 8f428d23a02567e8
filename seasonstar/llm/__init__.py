"""Operators for training text at scale."""

from seasonstar.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
