"""Registered queries by area, each with its DuckDB equivalent."""

from workload import (  # noqa: F401
    document_queries,
    flow_queries,
    ingest_queries,
    order_queries,
    table_queries,
)
from workload.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
