"""Imports every query module, which registers its queries."""

from . import cleaning_queries, source_queries, table_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
