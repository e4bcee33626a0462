"""Imports every operator, so that its query is registered."""

from seasonflow.llm import alignment, audit, bpe, decontaminate, language, licenses, pii, quality, sharding, simhash, substrings, toxicity, urls  # noqa: F401
from seasonflow.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
