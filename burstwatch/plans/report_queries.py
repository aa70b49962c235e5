"""The report tables over the edit lake and the alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstwatch.operators import features, report
from burstwatch.plans import tables
from burstwatch.plans.detect_queries import ALERTS_SQL, alert_rows
from burstwatch.plans.registry import query
from burstwatch.plans.tables import with_


@query(with_("edits") + """SELECT count(*) AS total_edits, count(*) FILTER (WHERE NOT bot) AS human_edits,
  count(*) FILTER (WHERE bot) AS bot_edits, count(*) FILTER (WHERE minor) AS minor_edits,
  CAST(sum(byte_change) AS BIGINT) AS net_byte_change FROM edits""")
def edit_summary(spark, folder):
    return report.edit_summary(tables.edits(spark, folder))


@query(with_("edits") + """SELECT CAST(epoch(date_trunc('minute', event_time)) AS BIGINT) AS minute, count(*) AS edits_per_minute
  FROM edits WHERE event_time >= (SELECT max(event_time) FROM edits) - INTERVAL 6 HOUR GROUP BY 1""")
def edits_per_minute(spark, folder):
    rows = report.edits_per_minute(tables.edits(spark, folder))
    return rows.withColumn("minute", F.unix_seconds("minute"))


@query(with_("edits") + "SELECT page_title, count(*) AS edits FROM edits GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_pages(spark, folder):
    return report.top_pages(tables.edits(spark, folder))


@query(with_("edits") + 'SELECT "user", count(*) AS edits FROM edits GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10')
def top_users(spark, folder):
    return report.top_users(tables.edits(spark, folder))


_EASTERN = "strftime(event_time - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M ET') AS time_et"


@query(with_("edits") + f"""SELECT {_EASTERN}, page_title, "user", bot, byte_change FROM edits
  WHERE byte_change > 0 ORDER BY byte_change DESC, event_id LIMIT 10""")
def largest_additions(spark, folder):
    return report.largest_additions(tables.edits(spark, folder))


@query(with_("edits") + f"""SELECT {_EASTERN}, page_title, "user", bot, byte_change FROM edits
  WHERE byte_change < 0 ORDER BY byte_change, event_id LIMIT 10""")
def largest_removals(spark, folder):
    return report.largest_removals(tables.edits(spark, folder))


@query(with_("edits") + f"""SELECT {_EASTERN}, page_title, "user", event_type, bot, minor, byte_change, partition, "offset"
  FROM edits ORDER BY event_time DESC, event_id LIMIT 100""")
def latest_edits(spark, folder):
    return report.latest_edits(tables.edits(spark, folder))


@query(with_("edits") + """SELECT page_title, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY event_time DESC, event_id) AS rn FROM edits) WHERE rn = 1""")
def latest_per_page(spark, folder):
    rows = report.latest_per_page(tables.edits(spark, folder), "event_time", [F.asc("event_id")])
    return rows.select("page_title", "event_id")


# Alerts of pages whose number ends in 3 come from old messages: no last edit, naive Eastern bounds.
def _mixed_alerts(spark, folder):
    old = F.col("page_title").endswith("3")
    naive = F.date_format(F.from_utc_timestamp(F.to_timestamp("window_end"), "America/New_York"), "yyyy-MM-dd HH:mm:ss")
    return alert_rows(spark, folder).withColumns({
        "last_edit_time": F.when(~old, F.col("last_edit_time")),
        "window_end": F.when(old, naive).otherwise(F.col("window_end")),
    })


_FILLED = ALERTS_SQL + """, last AS (SELECT page_title, max(event_time) AS page_last FROM edits GROUP BY 1),
  filled AS (SELECT a.* EXCLUDE (last_edit_time), strptime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end_ts,
    CASE WHEN a.page_title LIKE '%3' THEN page_last ELSE strptime(last_edit_time, '%Y-%m-%dT%H:%M:%SZ') END AS last_edit_ts
    FROM alerts a LEFT JOIN last USING (page_title))
"""


@query(_FILLED + """SELECT page_title, window_start, CAST(epoch(window_end_ts) AS BIGINT) AS window_end_ts,
  CAST(epoch(last_edit_ts) AS BIGINT) AS sort_ts FROM filled""")
def fill_last_edit(spark, folder):
    rows = report.fill_last_edit(_mixed_alerts(spark, folder), tables.edits(spark, folder))
    return rows.select(
        "page_title", "window_start", F.unix_seconds("window_end_ts").alias("window_end_ts"),
        F.unix_seconds("sort_ts").alias("sort_ts"),
    )


@query(_FILLED + """SELECT page_title, 'https://en.wikipedia.org/wiki/' || page_title AS wikipedia_url,
  strftime(last_edit_ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S ET') AS last_edit_display,
  round(anomaly_score, 6) AS anomaly_score, edit_count, unique_editors, total_byte_changes, recent_comments FROM (
    SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY last_edit_ts DESC, window_start DESC) AS rn FROM filled)
  WHERE rn = 1 AND regexp_matches(page_title, '(?i)page_[1-7]')""")
def alert_table(spark, folder):
    rows = report.alert_table(
        _mixed_alerts(spark, folder), tables.edits(spark, folder), "PAGE_[1-7]", ties=[F.desc("window_start")]
    )
    return rows.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query(ALERTS_SQL + "SELECT count(DISTINCT page_title) AS unique_pages, count(*) AS messages_read FROM alerts")
def alert_summary(spark, folder):
    return report.alert_summary(alert_rows(spark, folder))


@query("""SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\\bTHE (of|and)\\b')""")
def search_texts(spark, folder):
    """A case-insensitive pattern over whole documents."""
    docs = tables.table(spark, folder, "documents")
    return report.search(docs, "text", r"\bTHE (of|and)\b").select("doc_id")


@query(with_("edits", "tumbling") + """SELECT count(*) AS samples, count(DISTINCT page_title) AS distinct_pages FROM tumbling""")
def training_summary(spark, folder):
    return report.training_summary(features.tumbling(tables.edits(spark, folder)))


@query(with_("edits", "tumbling") + """SELECT page_title, edit_count, total_byte_changes FROM (
  SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY window_start) AS rn FROM tumbling)
  WHERE rn = 1 ORDER BY page_title LIMIT 10""")
def training_sample(spark, folder):
    rows = features.tumbling(tables.edits(spark, folder))
    return report.training_sample(rows, [F.asc("window.start")])


@query(with_("edits", "tumbling") + """SELECT count(*) AS rows, round(avg(CAST(edit_count = 1 AS DOUBLE)), 6) AS single_edit_share
  FROM tumbling""")
def training_distribution(spark, folder):
    rows = report.training_distribution(features.tumbling(tables.edits(spark, folder)))
    return rows.withColumn("single_edit_share", F.round("single_edit_share", 6))


@query("""SELECT CAST(1 AS BIGINT) AS files, count(*) AS records, 'event_id,ts,user_id,event_type,value,props' AS columns FROM events""")
def dataset_info(spark, folder):
    return report.dataset_info(tables.table(spark, folder, "events"))


@query("""SELECT doc_id AS id, lang, NULL::VARCHAR AS url FROM documents
  UNION ALL SELECT page_id, NULL, url FROM pages""")
def concat_frames(spark, folder):
    docs = tables.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang")
    pages = tables.table(spark, folder, "pages").select("url", F.col("page_id").alias("id"))
    return report.concat_frames([docs, pages])
