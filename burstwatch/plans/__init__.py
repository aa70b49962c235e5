"""Test-table roles, the registered queries and their reference SQL."""

from burstwatch.plans import (  # noqa: F401  (importing registers the queries)
    detect_queries, edit_queries, news_queries, report_queries, stream_queries, verify_queries,
)
from burstwatch.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
