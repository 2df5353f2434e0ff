"""Importing the query modules registers their queries."""

from checks import clean_queries, feature_queries, model_queries, profile_queries  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
