"""Every operator run on the driver tables, next to the SQL that states its result."""

from __future__ import annotations

from landgauge.catalog.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    """Import all query modules and return (queries, oracle SQL)."""
    from landgauge.catalog import (  # noqa: F401
        aggregates,
        features,
        filters,
        joins,
        learning,
        parsing,
        plans,
        reshaping,
        sources,
        streams,
    )

    return dict(QUERIES), dict(ORACLES)
