"""All registered queries."""

from ledgerlens.workload import (  # noqa: F401
    ingest_queries,
    relational_queries,
    report_queries,
    scalar_queries,
    source_queries,
)
from ledgerlens.workload.registry import QUERIES, SQL, runnable

__all__ = ["QUERIES", "SQL", "runnable"]
