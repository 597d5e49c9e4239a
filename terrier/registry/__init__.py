"""All registered queries with their SQL counterparts."""

from terrier.registry import columns, derived, loads, relations, results  # noqa: F401
from terrier.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
