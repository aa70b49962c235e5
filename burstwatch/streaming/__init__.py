"""Streaming jobs."""

from burstwatch.streaming.jobs import (
    index_news, ingest_news, landed_files, read_news_index, read_news_ledger, score_edits, verify_anomalies,
)
from burstwatch.streaming.state import RecentIds, first_comments, settled_minutes

__all__ = [
    "RecentIds", "first_comments", "index_news", "ingest_news", "landed_files", "read_news_index", "read_news_ledger",
    "score_edits", "settled_minutes", "verify_anomalies",
]
