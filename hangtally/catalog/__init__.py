"""Registered queries with their check SQL, one module per area."""

from __future__ import annotations

from hangtally.catalog import (  # noqa: F401
    aggregation, dashboard, extracts, forecast, joining, scalar, sizes, stocktaking, streams, tables,
)
from hangtally.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
