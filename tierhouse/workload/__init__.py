"""All registered queries."""

from . import cleaning, history, layers, quality, tables  # noqa: F401  (each registers its queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
