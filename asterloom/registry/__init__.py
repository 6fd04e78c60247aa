"""Every operator as a query over the given tables, with its SQL twin."""

from . import analysis, dedup, facts, files, loaded, loads, quality, stars, streams, values, versioned  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
