"""Registered queries, each next to the SQL that states its result."""

from gridloom.queries import exact, jobs, models, patterns, planted, relational  # noqa: F401
from gridloom.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
