"""Queries and the SQL that gives the same rows."""

from __future__ import annotations

from . import table_queries  # noqa: F401  registers its queries
from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
