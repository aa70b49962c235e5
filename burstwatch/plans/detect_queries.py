"""Alerts, scaling and the forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstwatch import sources
from burstwatch.operators import detect, features, report
from burstwatch.plans import tables
from burstwatch.plans.edit_queries import _clean_sql, _substantive_sql
from burstwatch.plans.forest_sql import forest_sql
from burstwatch.plans.registry import query
from burstwatch.plans.tables import SQL, with_
from burstwatch.schemas import FEATURES
from burstwatch.session import scratch_dir
from burstwatch.sources import sinks

# A stand-in for the model's score that SQL can follow; bursts fall below 0.
STAND_IN = "0.2e0 - 0.06e0 * edit_count - 0.1e0 * minor_edit_ratio - 0.05e0 * bot_ratio"


def stand_in_scored(spark, folder):
    rows = features.sliding(tables.edits(spark, folder), distinct="exact")
    return rows.withColumn("anomaly_score", F.expr(STAND_IN))


_ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _alerts_of(edits: str, scored: str, score: str) -> str:
    """CTEs up to ``alerts``: flagged rows of ``scored`` with the comments of ``edits``."""
    return f""", windowed AS (
    SELECT *, (timestamp // 300) * 300 - o AS w FROM {edits}, (VALUES (0), (300), (600)) s(o)),
  candidates AS (SELECT w, page_title, event_time, event_id, {_substantive_sql("c")} AS candidate
    FROM (SELECT *, {_clean_sql("comment")} AS c FROM windowed)),
  samples AS (SELECT w, page_title, string_agg(candidate, ' | ' ORDER BY rn) AS recent_comments FROM (
    SELECT *, row_number() OVER (PARTITION BY w, page_title ORDER BY event_time, event_id) AS rn
    FROM candidates WHERE candidate IS NOT NULL) WHERE rn <= 5 GROUP BY 1, 2),
  alerts AS (
    SELECT s.page_title, strftime(make_timestamp(window_start * 1000000), {_ISO}) AS window_start,
      strftime(make_timestamp((window_start + 900) * 1000000), {_ISO}) AS window_end,
      strftime(last_edit_time, {_ISO}) AS last_edit_time, edit_count, unique_editors, total_byte_changes,
      {score} AS anomaly_score, coalesce(recent_comments, '') AS recent_comments
    FROM {scored} s LEFT JOIN samples c ON c.w = s.window_start AND c.page_title = s.page_title
    WHERE {score} < 0)
"""


ALERTS_SQL = with_("edits", "sliding") + _alerts_of("edits", "sliding", f"CAST({STAND_IN} AS DOUBLE)")


def alert_rows(spark, folder):
    flagged = stand_in_scored(spark, folder).filter("anomaly_score < 0")
    return detect.alerts(features.attach_comments(flagged, tables.edits(spark, folder)))


@query(ALERTS_SQL + "SELECT * REPLACE (round(anomaly_score, 6) AS anomaly_score) FROM alerts")
def alerts(spark, folder):
    """Flagged sliding windows with their comment sample."""
    return alert_rows(spark, folder).withColumn("anomaly_score", F.round("anomaly_score", 6))


@query(ALERTS_SQL + """SELECT page_title AS key, to_json({page_title: page_title, window_start: window_start,
  edit_count: edit_count, unique_editors: unique_editors, recent_comments: recent_comments})::VARCHAR AS value FROM alerts""")
def keyed_alerts(spark, folder):
    """Alerts as the key and JSON value a topic takes."""
    rows = alert_rows(spark, folder)
    return sinks.keyed_json(
        rows.select("page_title", "window_start", "edit_count", "unique_editors", "recent_comments"), "page_title"
    )


@query(with_("edits", "sliding") + f"""SELECT window_start, page_title, CAST(CAST({STAND_IN} AS DOUBLE) < 0 AS INTEGER) AS is_anomaly FROM sliding""")
def label(spark, folder):
    return detect.label(stand_in_scored(spark, folder)).select(
        F.unix_seconds("window.start").alias("window_start"), "page_title", "is_anomaly"
    )


def _scaled_sql() -> str:
    parts = []
    for c in FEATURES:
        spread = f"(quantile_cont(CAST({c} AS DOUBLE), 0.75) OVER () - quantile_cont(CAST({c} AS DOUBLE), 0.25) OVER ())"
        middle = f"quantile_cont(CAST({c} AS DOUBLE), 0.5) OVER ()"
        parts.append(f"round((CAST({c} AS DOUBLE) - {middle}) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END, 6) + 0e0 AS {c}")
    return ", ".join(parts)


@query(with_("edits", "tumbling") + f"SELECT window_start, page_title, {_scaled_sql()} FROM tumbling")
def robust_scale(spark, folder):
    scaled = detect.robust_scale(features.tumbling(tables.edits(spark, folder)))
    return scaled.select(
        F.unix_seconds("window.start").alias("window_start"), "page_title",
        *[F.round(c, 6).alias(c) for c in FEATURES],
    )


def _training_features(spark, folder):
    return features.tumbling(tables.edits(spark, folder))


_RATIOS = """, total_byte_changes / edit_count AS relative_growth, minor_edit_ratio - bot_ratio AS human_bot_friction,
    unique_editors / edit_count AS editor_concentration"""
_SLIDING_SCORED = with_("edits", "sliding", "tumbling") + f", windows AS (SELECT *{_RATIOS} FROM sliding)," + forest_sql("tumbling", "windows")


@query(_SLIDING_SCORED + """ SELECT window_start, page_title, edit_count, round(anomaly_score, 6) AS anomaly_score FROM scored""")
def forest_scores(spark, folder):
    """Train on the tumbling windows and score the sliding ones."""
    model = detect.IsolationForest.fit(_training_features(spark, folder))
    scored = model.score(features.sliding(tables.edits(spark, folder), distinct="exact"))
    return scored.select(
        F.unix_seconds("window.start").alias("window_start"), "page_title", "edit_count",
        F.round("anomaly_score", 6).alias("anomaly_score"),
    )


def forest_alerts_sql(sent: str = "true") -> str:
    """The forest of all edits; windows and alerts of those that were ``sent``."""
    return (
        with_("edits", "tumbling") + f", sent AS (SELECT * FROM edits WHERE {sent}), "
        + SQL["sliding"].replace("FROM edits,", "FROM sent,") + f", windows AS (SELECT *{_RATIOS} FROM sliding),"
        + forest_sql("tumbling", "windows") + _alerts_of("sent", "scored", "anomaly_score")
        + "SELECT * REPLACE (round(anomaly_score, 6) AS anomaly_score) FROM alerts"
    )


@query(forest_alerts_sql())
def forest_alerts(spark, folder):
    """The detection job on a table: features, saved and reloaded model, score, alerts, comments."""
    path = scratch_dir(spark, "model")
    detect.IsolationForest.fit(_training_features(spark, folder)).save(spark, path)
    edits = tables.edits(spark, folder)
    scored = detect.IsolationForest.load(spark, path).score(features.sliding(edits))
    alerts = detect.alerts(features.attach_comments(scored.filter("anomaly_score < 0"), edits))
    return alerts.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query(with_("edits", "tumbling") + "," + forest_sql("tumbling", "tumbling") + """ SELECT count(*) AS "rows",
    avg(CAST(edit_count = 1 AS DOUBLE)) AS single_edit_share, avg(CAST(anomaly_score < 0 AS DOUBLE)) AS flagged_share FROM scored""")
def forest_self_flag_rate(spark, folder):
    """Share of its own training rows the model flags."""
    rows = _training_features(spark, folder)
    return report.training_distribution(detect.IsolationForest.fit(rows).score(rows), "anomaly_score")


@query(with_("edits") + f""", days AS (
  SELECT *{_RATIOS} FROM (SELECT timestamp // 86400 AS day, page_title, count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
    CAST(sum(abs(byte_change)) AS BIGINT) AS total_byte_changes, avg(CAST(bot AS DOUBLE)) AS bot_ratio,
    avg(CAST(minor AS DOUBLE)) AS minor_edit_ratio FROM edits GROUP BY 1, 2)),
  firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY edit_count DESC, total_byte_changes DESC,
    unique_editors DESC, bot_ratio DESC, minor_edit_ratio DESC) AS rn FROM days) WHERE rn = 1),""" + forest_sql("days", "firsts") + """
  SELECT page_title, edit_count, total_byte_changes, CAST(anomaly_score < 0 AS INTEGER) AS is_anomaly FROM scored""")
def score_feature_lake(spark, folder):
    """The feature lake written per page and day, read back, and scored one row per page."""
    path = scratch_dir(spark, "features")
    edits = tables.edits(spark, folder).withColumn("day", F.to_date("event_time"))
    days = features.per_page(edits, "exact", ("day", "page_title"))
    days.write.partitionBy("day").parquet(path)
    lake = sources.read_feature_lake(spark, path)
    model = detect.IsolationForest.fit(lake)
    order = [F.desc(c) for c in ("edit_count", "total_byte_changes", "unique_editors", "bot_ratio", "minor_edit_ratio")]
    scored = detect.score_lake(lake, model, order)
    return scored.select("page_title", "edit_count", "total_byte_changes", "is_anomaly")


@query(with_("edits") + """SELECT page_title, edit_count, total_byte_changes FROM (
  SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY edit_count DESC, total_byte_changes DESC) AS rn FROM (
    SELECT timestamp // 86400 AS day, page_title, count(*) AS edit_count,
      CAST(sum(abs(byte_change)) AS BIGINT) AS total_byte_changes FROM edits GROUP BY 1, 2)) WHERE rn = 1""")
def one_per_page(spark, folder):
    days = tables.edits(spark, folder).groupBy(F.to_date("event_time").alias("day"), "page_title").agg(
        F.count("event_id").alias("edit_count"), F.sum(F.abs("byte_change")).alias("total_byte_changes")
    )
    order = [F.desc("edit_count"), F.desc("total_byte_changes")]
    return detect.one_per_page(days, order).drop("day")
