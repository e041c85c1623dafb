"""Queries and oracle SQL of this subpackage, by name."""

from __future__ import annotations

from . import chat, sharding
from . import queries as q


def queries() -> dict:
    return {name: f for name, f in vars(q).items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": chat.ORACLE, "op2_hilbert_sharding": sharding.ORACLE}
