"""Column functions: everything here is a native expression, no Python UDF."""

from burstwatch.functions.text import (
    anomaly_text, article_text, clean_comment, edge_trim, strip, substantive_comment,
)
from burstwatch.functions.times import (
    format_eastern, iso_to_epoch, iso_utc, minute_key, parse_window_time, to_eastern,
    window_label,
)
from burstwatch.functions.vectors import cosine
from burstwatch.functions.web import page_url, stable_id, url_domain

__all__ = [
    "anomaly_text", "article_text", "clean_comment", "cosine", "edge_trim",
    "format_eastern", "iso_to_epoch", "iso_utc", "minute_key", "page_url",
    "parse_window_time", "stable_id", "strip", "substantive_comment", "to_eastern",
    "url_domain", "window_label",
]
