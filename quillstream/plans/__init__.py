"""Compositions: the ingestion plan, the registered queries and their oracle SQL."""
