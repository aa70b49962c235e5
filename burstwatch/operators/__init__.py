"""Batch operators; each takes and returns DataFrames."""

from burstwatch.operators import detect, edits, features, news, report, verify

__all__ = ["detect", "edits", "features", "news", "report", "verify"]
