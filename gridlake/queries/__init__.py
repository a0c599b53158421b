"""The registered queries over the given tables, each with the SQL that must give the same rows."""

from gridlake.queries import aggregates, layers, loading, missing, numeric, quality, statistics, streams, web  # noqa: F401
from gridlake.queries.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
