"""All registered queries."""

from __future__ import annotations

from registry import loads, primitives, reports
from registry.views import Query

_PARTS = (reports, primitives, loads)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
for _part in _PARTS:
    QUERIES.update(_part.QUERIES)
    ORACLES.update(_part.ORACLES)
