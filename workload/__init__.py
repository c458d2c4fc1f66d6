"""The library's operators applied to the driver's tables, each next to the SQL
that must give the same rows."""

from workload.base import ORACLE, QUERIES

from workload import (  # noqa: F401  (each module registers its queries)
    arrival_queries,
    clean_queries,
    file_queries,
    field_queries,
    harvest_queries,
    integrity_queries,
    language_queries,
    link_queries,
    quality_queries,
    record_queries,
    relevance_queries,
    stream_queries,
)

__all__ = ["ORACLE", "QUERIES"]
