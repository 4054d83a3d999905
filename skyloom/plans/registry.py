"""All queries of the engine and the SQL they are checked against."""

from __future__ import annotations

from . import asset_queries, box_queries, file_queries, frame_queries, graph_queries, raster_queries, run_queries  # noqa: F401
from .base import ORACLE_SQL, QUERIES

FLAGSHIP = "run_totals"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
