"""Queries over the given tables, each next to the SQL that says what it should return."""

from suite import artifacts, evaluation, features, models, profiling, programs, quality, stratify  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
