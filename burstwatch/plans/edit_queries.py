"""Decoding, normalizing, cleaning and windowed features of edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstwatch import sources
from burstwatch.functions import (
    anomaly_text, article_text, clean_comment, edge_trim, format_eastern, iso_utc, minute_key,
    page_url, parse_window_time, stable_id, substantive_comment, to_eastern, url_domain,
    window_label,
)
from burstwatch.operators import edits, features
from burstwatch.plans import tables
from burstwatch.plans.registry import query
from burstwatch.plans.tables import with_
from burstwatch.session import scratch_dir
from burstwatch.sources import sinks

_EDIT_COLUMNS = (
    'event_id, recent_change_id, revision_id, timestamp, page_title, namespace, "user", bot, minor, '
    "old_length, new_length, byte_change, comment, server_name, event_type"
)


@query(with_("edits") + f"""SELECT {_EDIT_COLUMNS}, partition, "offset",
  CAST(epoch_us(kafka_timestamp) AS BIGINT) AS kafka_us
  FROM edits WHERE NOT bot AND event_type <> 'new'""")
def decode_edits(spark, folder):
    rows = sources.decode_edits(tables.edit_messages(spark, folder), metadata=True)
    return rows.withColumn("kafka_us", F.unix_micros("kafka_timestamp")).drop("kafka_timestamp")


@query(f"""SELECT 'm' || event_id AS event_id, event_id AS recent_change_id, event_id + 1000 AS revision_id,
  CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, 'page_' || json_extract_string(props, '$.k') AS page_title,
  CAST(0 AS BIGINT) AS namespace, 'u' || user_id AS "user",
  CASE event_type WHEN 'view' THEN false WHEN 'purchase' THEN NULL ELSE value > 10 END AS bot,
  CASE event_type WHEN 'view' THEN false WHEN 'purchase' THEN NULL ELSE value > 20 END AS minor,
  CASE WHEN event_type IN ('click', 'signup') THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS old_length,
  CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(round(value * 100) AS BIGINT) + 50 END AS new_length,
  CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN CAST(round(value * 100) AS BIGINT) + 50 ELSE 50 END AS byte_change,
  CASE event_type WHEN 'click' THEN '' ELSE ([{tables._LIST}])[event_id % {len(tables.COMMENTS)} + 1] END AS comment,
  'en.wikipedia.org' AS server_name,
  CASE event_type WHEN 'signup' THEN 'new' ELSE 'edit' END AS event_type
  FROM events WHERE event_type <> 'error' AND user_id % 7 <> 0 AND user_id % 11 <> 0""")
def normalize_changes(spark, folder):
    return edits.normalize(edits.in_scope(tables.change_feed(spark, folder)))


_HISTORY = with_("edits") + """, history AS (
  SELECT CAST(event_id AS BIGINT) AS n, page_title, "user",
    CASE CAST(event_id AS BIGINT) % 6 WHEN 0 THEN bot WHEN 1 THEN bot WHEN 3 THEN true ELSE false END AS bot,
    CASE CAST(event_id AS BIGINT) % 6 WHEN 0 THEN minor ELSE false END AS minor,
    CAST(CASE CAST(event_id AS BIGINT) % 6 WHEN 0 THEN byte_change
      WHEN 1 THEN new_length - old_length ELSE 0 END AS DOUBLE) AS byte_change, timestamp
  FROM edits WHERE CAST(event_id AS BIGINT) % 6 < 4)
"""


@query(_HISTORY + 'SELECT page_title, "user", bot, minor, byte_change, timestamp FROM history')
def normalize_history(spark, folder):
    lines = tables.history_lines(spark, folder)
    return edits.normalize_history(sources.decode_history(lines))


@query(with_("edits") + """SELECT page_title, "user", CASE WHEN minor THEN false ELSE bot END AS bot, minor,
  CASE WHEN bot THEN 0 ELSE timestamp END AS timestamp,
  CASE WHEN event_type = 'new' THEN 0 ELSE new_length - old_length END AS byte_change
  FROM edits WHERE NOT (minor AND ("user" LIKE '%7' OR "user" LIKE '%3'))""")
def normalize_api_changes(spark, folder):
    return edits.normalize_api_changes(tables.api_changes(spark, folder))


@query(with_("edits") + """, api AS (
  SELECT page_title, "user", CASE WHEN minor THEN false ELSE bot END AS bot, minor,
    CASE WHEN bot THEN 0 ELSE timestamp END AS timestamp,
    CASE WHEN event_type = 'new' THEN 0 ELSE new_length - old_length END AS byte_change
  FROM edits WHERE NOT (minor AND ("user" LIKE '%7' OR "user" LIKE '%3')))
  SELECT (timestamp // 900) * 900 AS window_start, page_title, count(*) AS edit_count,
    count(DISTINCT "user") AS unique_editors, CAST(sum(abs(byte_change)) AS DOUBLE) AS total_byte_changes,
    round(avg(CAST(bot AS DOUBLE)), 6) AS bot_ratio
  FROM api GROUP BY 1, 2""")
def history_round_trip(spark, folder):
    """API changes written as history files, read back strictly, and turned into training features."""
    path = scratch_dir(spark, "history")
    sinks.write_history(edits.normalize_api_changes(tables.api_changes(spark, folder)), path)
    records = edits.normalize_history(sources.read_history(spark, path))
    rows = features.tumbling(edits.with_event_time(records))
    return rows.select(
        F.unix_seconds("window.start").alias("window_start"), "page_title", "edit_count",
        "unique_editors", "total_byte_changes", F.round("bot_ratio", 6).alias("bot_ratio"),
    )


def _clean_sql(text: str) -> str:
    steps = [
        (r"^(?i)(?:Undid|Restored)\s+revisions?\s+\d+(?:\s*(?:through|to|-)\s*\d+)?\s+by\s+\[\[[^\]]*\]\](?:\s*\(\[\[[^\]]*\]\]\))?\s*:?\s*", ""),
        (r"/\*\s*(.*?)\s*\*/", r"\1"),
        (r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]", r"\1"),
        (r"\{\{|\}\}|\|", " "),
        (r"\s+", " "),
    ]
    sql = f"trim(coalesce({text}, ''), ' ' || chr(9) || chr(10) || chr(13))"
    for pattern, replacement in steps:
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    return f"trim({sql})"


def _substantive_sql(cleaned: str) -> str:
    from burstwatch.functions.text import JARGON

    words = ", ".join(f"'{w}'" for w in JARGON)
    content = f"list_filter(regexp_extract_all(lower({cleaned}), '[a-z0-9]+'), lambda w: w NOT IN ({words}))"
    return f"CASE WHEN len({content}) > 0 THEN {cleaned} END"


@query(with_("edits") + f""", cleaned AS (SELECT event_id, {_clean_sql("comment")} AS cleaned FROM edits)
  SELECT event_id, cleaned, {_substantive_sql("cleaned")} AS substantive FROM cleaned""")
def clean_edit_comments(spark, folder):
    comment = F.col("comment")
    return tables.edits(spark, folder).select(
        "event_id", clean_comment(comment).alias("cleaned"),
        substantive_comment(comment).alias("substantive"),
    )


@query(f"""WITH marked AS (SELECT doc_id,
    '/* ' || source || ' */ [[' || lang || '|' || source || ']] {{{{note|' || text || '}}}}' AS comment FROM documents),
  cleaned AS (SELECT doc_id, {_clean_sql("comment")} AS cleaned FROM marked)
  SELECT doc_id, cleaned, {_substantive_sql("cleaned")} AS substantive FROM cleaned""")
def clean_whole_texts(spark, folder):
    """The cleaner over whole documents wrapped in every kind of markup."""
    comment = F.concat(
        F.lit("/* "), "source", F.lit(" */ [["), "lang", F.lit("|"), "source",
        F.lit("]] {{note|"), "text", F.lit("}}"),
    )
    return tables.spread_table(spark, folder, "documents").select(
        "doc_id", clean_comment(comment).alias("cleaned"), substantive_comment(comment).alias("substantive")
    )


@query("""SELECT doc_id, trim(replace(source || '_' || lang, '_', ' ')) || ' ' || t AS anomaly_text,
  CASE WHEN t = '' THEN 'Title ' || doc_id ELSE 'Title ' || doc_id || '. ' || t END AS article_text, sha256(text) AS id,
  trim(text, ' ' || chr(9) || chr(13) || chr(10) || '.,;:!?"''()[]{}') AS trimmed
  FROM (SELECT *, trim(text, ' ' || chr(9) || chr(13) || chr(10)) AS t FROM documents)""")
def build_texts(spark, folder):
    title = F.concat(F.lit(" Title "), F.col("doc_id"))
    page = F.concat("source", F.lit("_"), "lang", F.lit("_"))
    return tables.spread_table(spark, folder, "documents").select(
        "doc_id",
        anomaly_text(page, F.col("text")).alias("anomaly_text"),
        article_text(title, F.col("text")).alias("article_text"),
        F.sha2("text", 256).alias("id"),
        edge_trim(F.col("text")).alias("trimmed"),
    )


@query("""SELECT page_id, sha256(trim(url)) AS id, nullif(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '') AS domain,
  'https://en.wikipedia.org/wiki/' || replace(replace(url_encode(replace(url, ' ', '_')), '%2F', '/'), '%7E', '~') AS page
  FROM pages""")
def url_functions(spark, folder):
    url = F.col("url")
    return tables.table(spark, folder, "pages").select(
        "page_id", stable_id(F.concat(F.lit("  "), url, F.lit(" "))).alias("id"),
        url_domain(url).alias("domain"), page_url(url).alias("page"),
    )


@query(r"""WITH shifted AS (SELECT event_id, date_trunc('second', ts) + to_days(CAST(event_id % 365 AS INTEGER)) AS t FROM events),
  texts AS (SELECT *, timezone('America/New_York', timezone('UTC', t)) AS eastern FROM shifted)
  SELECT event_id, strftime(t, '%Y%m%d%H%M00') AS minute, strftime(eastern, '%Y-%m-%d %H:%M ET') AS shown,
    CAST(epoch(t) AS BIGINT) AS from_iso, CAST(epoch(t) AS BIGINT) AS from_offset,
    CASE WHEN strftime(eastern, '%m-%d %H') NOT IN ('03-10 02', '11-03 01') THEN CAST(epoch(t) AS BIGINT) END AS from_eastern,
    strftime(eastern, '%b %d %H:%M') || ' – ' || strftime(timezone('America/New_York', timezone('UTC', t + to_minutes(15))), '%H:%M') || ' ET' AS label,
    '? – later' AS fallback
  FROM texts""")
def time_functions(spark, folder):
    """Round trips through every accepted time format, over a whole year of dates."""
    t = F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") % 365 * 86400)
    rows = tables.spread_table(spark, folder, "events").select("event_id", t.alias("t"))
    eastern = F.date_format(to_eastern(F.col("t")), "yyyy-MM-dd HH:mm:ss")
    ambiguous = F.date_format(to_eastern(F.col("t")), "MM-dd HH").isin("03-10 02", "11-03 01")
    iso, later = iso_utc(F.col("t")), iso_utc(F.col("t") + F.expr("INTERVAL 15 MINUTES"))
    with_offset = F.concat(F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
    return rows.select(
        "event_id",
        minute_key(F.col("t")).alias("minute"),
        format_eastern(F.col("t")).alias("shown"),
        F.unix_seconds(parse_window_time(iso)).alias("from_iso"),
        F.unix_seconds(parse_window_time(with_offset)).alias("from_offset"),
        F.when(~ambiguous, F.unix_seconds(parse_window_time(eastern))).alias("from_eastern"),
        window_label(iso, later).alias("label"),
        window_label(F.lit(""), F.lit("later")).alias("fallback"),
    )


_FEATURE_SQL = """edit_count, unique_editors, total_byte_changes, round(bot_ratio, 6) AS bot_ratio,
  round(minor_edit_ratio, 6) AS minor_edit_ratio, round(total_byte_changes / edit_count, 6) AS relative_growth,
  round(minor_edit_ratio - bot_ratio, 6) AS human_bot_friction,
  round(unique_editors / edit_count, 6) AS editor_concentration"""


def rounded(rows, *keys):
    exact = ["edit_count", "unique_editors", "total_byte_changes"]
    ratios = ["bot_ratio", "minor_edit_ratio", "relative_growth", "human_bot_friction", "editor_concentration"]
    return rows.select(*keys, *exact, *[F.round(c, 6).alias(c) for c in ratios])


@query(with_("edits", "sliding") + f"""SELECT window_start, page_title, CAST(epoch(last_edit_time) AS BIGINT) AS last_edit, {_FEATURE_SQL} FROM sliding""")
def sliding_features(spark, folder):
    rows = features.sliding(tables.edits(spark, folder), distinct="exact")
    start = F.unix_seconds("window.start").alias("window_start")
    return rounded(rows, start, "page_title", F.unix_seconds("last_edit_time").alias("last_edit"))


@query(with_("edits", "sliding") + """SELECT window_start, page_title, edit_count, unique_editors, total_byte_changes,
  round(bot_ratio, 6) AS bot_ratio, round(minor_edit_ratio, 6) AS minor_edit_ratio, true AS within_error FROM sliding""")
def sliding_features_approx(spark, folder):
    """Windows from panes whose editor sketches are merged; the estimate beside the exact count.

    ``within_error``: off by at most three of the sketch's standard errors.
    """
    events = tables.edits(spark, folder)
    keys = ["window", "page_title"]
    exact = features.sliding(events, distinct="exact").select(*keys, "unique_editors")
    approx = features.sliding(events).withColumnRenamed("unique_editors", "estimate")
    error = F.lit(3 * 1.04 / 2 ** (features.SKETCH / 2)) * F.col("unique_editors")
    return approx.join(exact, keys).select(
        F.unix_seconds("window.start").alias("window_start"), "page_title", "edit_count", "unique_editors",
        "total_byte_changes", *[F.round(c, 6).alias(c) for c in ("bot_ratio", "minor_edit_ratio")],
        (F.abs(F.col("estimate") - F.col("unique_editors")) <= error).alias("within_error"),
    )


@query(with_("edits", "tumbling") + f"SELECT window_start, page_title, {_FEATURE_SQL} FROM tumbling")
def tumbling_features(spark, folder):
    rows = features.tumbling(tables.edits(spark, folder))
    return rounded(rows, F.unix_seconds("window.start").alias("window_start"), "page_title")


@query(with_("edits") + f"""SELECT page_title, {_FEATURE_SQL} FROM (
  SELECT page_title, count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
    CAST(sum(abs(byte_change)) AS BIGINT) AS total_byte_changes,
    avg(CAST(bot AS DOUBLE)) AS bot_ratio, avg(CAST(minor AS DOUBLE)) AS minor_edit_ratio
  FROM edits GROUP BY page_title)""")
def page_features(spark, folder):
    return rounded(features.per_page(tables.edits(spark, folder), distinct="exact"), "page_title")


@query(with_("edits") + f""", cleaned AS (SELECT *, {_clean_sql("comment")} AS c FROM edits),
  chosen AS (SELECT (timestamp // 86400) * 86400 AS day, page_title, {_substantive_sql("c")} AS candidate, event_time, event_id FROM cleaned),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY day, page_title ORDER BY event_time, event_id) AS rn
    FROM chosen WHERE candidate IS NOT NULL)
  SELECT day, page_title, string_agg(candidate, ' | ' ORDER BY rn) AS recent_comments FROM numbered WHERE rn <= 5 GROUP BY 1, 2""")
def comment_sample(spark, folder):
    """The first substantive comments per page and day."""
    day = F.floor(F.col("timestamp") / 86400) * 86400
    return features.comment_sample(
        tables.edits(spark, folder).withColumn("day", day.cast("long")), ["day", "page_title"]
    )
