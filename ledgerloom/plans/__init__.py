"""Registered queries with their SQL twins."""

from ledgerloom.plans import card, ingest, operations, quality, retail, streams, support  # noqa: F401  (register on import)
from ledgerloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
