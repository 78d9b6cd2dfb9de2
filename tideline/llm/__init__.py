"""Operators of a training-data pipeline; nothing else in the library imports them."""

from tideline.llm import chat, decontaminate, jaccard, langid, negatives, neighbours, packing, pages, sharding, tokens, toxicity, whitening  # noqa: F401
from tideline.llm.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
