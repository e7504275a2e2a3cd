"""Queries over the driver's tables, with the same queries as SQL."""

from listloom.catalog import file_queries, queries  # noqa: F401  (they register themselves)
from listloom.catalog.oracle import oracle_sql
from listloom.catalog.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)


__all__ = ["all_queries", "oracle_sql"]
