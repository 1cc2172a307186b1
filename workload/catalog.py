"""Importing this module registers every query."""

from . import report_queries, series_queries, stream_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
