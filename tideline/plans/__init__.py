"""Registered queries over the given tables."""

from tideline.plans import changes, comments, profiles, scalars, storage, trade, traffic  # noqa: F401
from tideline.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
