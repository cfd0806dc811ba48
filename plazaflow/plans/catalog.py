"""All registered queries of the library, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import curation, evaluation, forms, market, points, records, registry, scalars, storage, vectors

__all__ = ["FLAGSHIP", "QUERIES", "SQL", "curation", "evaluation", "forms", "market", "points", "records", "scalars", "storage", "vectors"]

QUERIES = registry.QUERIES
SQL = registry.SQL
FLAGSHIP = "match_orders"
