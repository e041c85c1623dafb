"""Queries and oracle SQL of the ingestion engine, by name."""

from .oracle import oracle_sql
from .queries import queries

__all__ = ["oracle_sql", "queries"]
