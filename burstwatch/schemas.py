"""Record layouts that cross a topic or a file."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the records on the topics and files.
EDIT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("recent_change_id", T.LongType()),
    T.StructField("revision_id", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("namespace", T.LongType()),
    T.StructField("user", T.StringType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("old_length", T.LongType()),
    T.StructField("new_length", T.LongType()),
    T.StructField("byte_change", T.LongType()),
    T.StructField("comment", T.StringType()),
    T.StructField("server_name", T.StringType()),
    T.StructField("event_type", T.StringType()),
])

# The feature-lake job reads the same records without the comment.
EDIT_SCHEMA_NO_COMMENT = T.StructType([f for f in EDIT_SCHEMA if f.name != "comment"])

EDIT_LAKE_SCHEMA = T.StructType(EDIT_SCHEMA.fields + [
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
])

CHANGE_FEED_SCHEMA = (
    "id long, type string, namespace long, title string, user string, bot boolean, "
    "minor boolean, timestamp long, comment string, server_name string, "
    "meta struct<id string>, length struct<old long, new long>, revision struct<new long>"
)

# Loose history records: every accepted spelling. Flags stay variants because
# a JSON string and a JSON boolean are judged differently; numbers stay strings
# so that unreadable ones become 0 instead of voiding the record.
HISTORY_SCHEMA = (
    "page_title string, title string, page string, user string, user_name string, "
    "bot variant, minor variant, byte_change string, "
    "old_length string, oldlen string, new_length string, newlen string, "
    "timestamp string, ts string, time string"
)

TOC_SCHEMA = "ID long, date string, img string, lang string, title string, url string"

NEWS_SCHEMA = (
    "event_id string, toc_id long, toc_timestamp string, gdelt_seen_at string, "
    "observed_at string, title string, url string, language string, image_url string, "
    "snippet string, source string, event_type string"
)

ANOMALY_SCHEMA = (
    "page_title string, window_start string, window_end string, last_edit_time string, "
    "edit_count long, unique_editors long, total_byte_changes long, anomaly_score double, "
    "recent_comments string"
)

ARTICLE_FIELDS = ("title", "url", "language", "event_id", "gdelt_seen_at", "observed_at")
ARTICLE_SCHEMA = "struct<" + ", ".join(f"{name}: string" for name in ARTICLE_FIELDS) + ">"

VERDICT_SCHEMA = (
    "page_title string, window_start string, window_end string, anomaly_score double, "
    "edit_count long, recent_comments string, unique_editors long, total_byte_changes long, "
    "matched boolean, similarity_score double, similarity_threshold double, "
    f"matched_article {ARTICLE_SCHEMA}, closest_article {ARTICLE_SCHEMA}, evaluated_at string"
)

# Order of the model's feature vector.
FEATURES = (
    "edit_count",
    "unique_editors",
    "total_byte_changes",
    "bot_ratio",
    "minor_edit_ratio",
    "relative_growth",
    "human_bot_friction",
    "editor_concentration",
)
