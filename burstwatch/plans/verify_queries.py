"""Matching and verdicts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from burstwatch import sources
from burstwatch.functions.text import article_text
from burstwatch.functions.vectors import cosine
from burstwatch.operators import news, report, verify
from burstwatch.operators.nearest import nearest_news as nearest
from burstwatch.plans import tables
from burstwatch.plans.detect_queries import ALERTS_SQL, alert_rows
from burstwatch.plans.registry import query
from burstwatch.plans.tables import EMBED_SQL, with_
from burstwatch.schemas import VERDICT_SCHEMA
from burstwatch.session import cut_lineage

EVALUATED = datetime(2024, 2, 1, tzinfo=timezone.utc)

_NEAREST = with_("pairs") + """SELECT e.vec_id AS total_byte_changes, round(p.similarity, 6) AS similarity_score,
  CASE WHEN p.a IS NOT NULL THEN 'article ' || p.a END AS title
  FROM embeddings e LEFT JOIN pairs p ON p.q = e.vec_id AND p.rn = 1"""


def _found(rows):
    return rows.select(
        "total_byte_changes", F.round("similarity_score", 6).alias("similarity_score"), "article.title"
    )


@query(_NEAREST)
def nearest_news(spark, folder):
    """Every vector's most similar article of the day before."""
    return _found(nearest(
        tables.vector_anomalies(spark, folder), tables.vector_news(spark, folder), materialize=False
    ))


@query(_NEAREST)
def nearest_news_pruned(spark, folder):
    """The same with small leaves and blocks, so that the tree is some levels deep."""
    return _found(nearest(
        tables.vector_anomalies(spark, folder), tables.vector_news(spark, folder),
        article_block=16, anomaly_block=64, fanout=4, materialize=False,
    ))


@query(with_("pairs") + """SELECT 'page_' || e.vec_id AS page_title,
  strftime(TIMESTAMP '2024-01-01' + to_minutes(10 * e.vec_id - 15), '%Y-%m-%dT%H:%M:%SZ') AS window_start,
  coalesce(p.similarity >= 0.65, false) AS matched, round(p.similarity, 6) AS similarity_score, 0.65e0 AS similarity_threshold,
  CASE WHEN p.similarity >= 0.65 THEN 'https://news.example.com/' || p.a END AS matched_url,
  CASE WHEN p.a IS NOT NULL THEN 'https://news.example.com/' || p.a END AS closest_url,
  '2024-02-01T00:00:00.000000Z' AS evaluated_at
  FROM embeddings e LEFT JOIN pairs p ON p.q = e.vec_id AND p.rn = 1""")
def verdicts(spark, folder):
    rows = verify.verdicts(
        tables.vector_anomalies(spark, folder), tables.vector_news(spark, folder), evaluated_at=EVALUATED,
        materialize=False,
    )
    return rows.select(
        "page_title", "window_start", "matched", F.round("similarity_score", 6).alias("similarity_score"),
        "similarity_threshold", F.col("matched_article.url").alias("matched_url"),
        F.col("closest_article.url").alias("closest_url"), "evaluated_at",
    )


@query("""SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_similarity(spark, folder):
    """Similarity of each vector to its successor."""
    e = tables.table(spark, folder, "embeddings")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return e.join(following, "vec_id").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("next")), 6).alias("similarity")
    )


def fitted_embedder(articles):
    """Words weighted by their rarity in the texts of ``articles``."""
    texts = articles.select(article_text(F.col("title"), F.col("snippet")).alias("text"))
    return verify.HashedTextEmbedder().fit(texts, "text")


@query(with_("toc", "articles", "ngrams", "snippets") + """, texts AS (
    SELECT 'article' AS kind, toc_id AS id, concat_ws('. ', title, nullif(snippet, '')) AS text FROM articles a
    LEFT JOIN snippets s ON s.docid = a.toc_id AND s.toc_timestamp = a.toc_timestamp),""" + EMBED_SQL + """
  SELECT id AS toc_id, i AS place, round(CAST(v[i + 1] AS DOUBLE), 6) AS weight
  FROM vectors, unnest(range(384)) r(i) WHERE v[i + 1] <> 0""")
def embed_articles(spark, folder):
    """Vectors of whole articles with words weighted by rarity, every weight that is not 0."""
    articles = news.attach_snippets(
        tables.toc(spark, folder), news.build_snippets(tables.ngrams(spark, folder), ("toc_timestamp", "docid"))
    )
    # read twice, to fit and to embed
    rows = cut_lineage(news.normalize(articles).select("toc_id", "title", "snippet"))
    places = verify.embed_articles(rows, fitted_embedder(rows)).select("toc_id", F.posexplode("embedding").alias("place", "weight"))
    return places.filter("weight <> 0").select(
        "toc_id", F.col("place").cast("bigint").alias("place"), F.round(F.col("weight").cast("double"), 6).alias("weight")
    )


@query(ALERTS_SQL.rstrip() + ",\n" + with_("toc", "articles", "ngrams", "snippets").removeprefix("WITH ") + """, firsts AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY toc_timestamp, pos) AS rn FROM articles) WHERE rn = 1),
  texts AS (
    SELECT 'article' AS kind, CAST(toc_id AS VARCHAR) AS id, concat_ws('. ', title, nullif(snippet, '')) AS text FROM firsts a
    LEFT JOIN snippets s ON s.docid = a.toc_id AND s.toc_timestamp = a.toc_timestamp
    UNION ALL SELECT 'alert', page_title || ' ' || window_start,
      concat_ws(' ', replace(page_title, '_', ' '), nullif(trim(recent_comments), '')) FROM alerts),""" + EMBED_SQL + """,
  listed AS (SELECT v, strptime(toc_timestamp, '%Y%m%d%H%M%S') AS added FROM vectors JOIN firsts ON id = CAST(toc_id AS VARCHAR)
    WHERE kind = 'article'),
  asked AS (SELECT page_title, window_start, v, strptime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS handled FROM alerts
    JOIN vectors ON kind = 'alert' AND id = page_title || ' ' || window_start),
  best AS (SELECT page_title, window_start, max(list_cosine_similarity(a.v::DOUBLE[], l.v::DOUBLE[])) AS similarity
    FROM asked a JOIN listed l ON added <= handled AND added >= handled - INTERVAL 24 HOUR GROUP BY 1, 2)
  SELECT page_title, window_start, coalesce(similarity >= 0.65, false) AS matched, round(similarity, 6) AS similarity_score
  FROM alerts LEFT JOIN best USING (page_title, window_start)""")
def verify_alerts(spark, folder):
    """Alerts judged against the documents as news: embedding weighted by rarity, nearest article, verdict."""
    articles = cut_lineage(news.assemble(tables.toc(spark, folder), tables.ngrams(spark, folder)))
    embedder = fitted_embedder(articles)
    indexed = verify.embed_articles(articles, embedder).withColumn("added_at", F.to_timestamp("toc_timestamp", "yyyyMMddHHmmss"))
    alerts = verify.embed_anomalies(alert_rows(spark, folder), embedder).withColumn(
        "handled_at", F.to_timestamp("window_end")
    )
    rows = verify.verdicts(alerts, indexed, evaluated_at=EVALUATED)
    return rows.select(
        "page_title", "window_start", "matched", F.round("similarity_score", 6).alias("similarity_score")
    )


REQUIRED = ["page_title", "matched"]


def _records(spark, folder):
    messages = tables.verdict_messages(spark, folder)
    return sources.decode_json(messages, VERDICT_SCHEMA, ["offset"], require=REQUIRED)


@query(with_("verdicts") + """SELECT event_id AS "offset", page_title, window_start, matched,
  round(similarity_score, 6) AS similarity_score, recent_comments FROM verdicts""")
def decode_verdicts(spark, folder):
    """Readable verdict messages that carry the required fields."""
    return _records(spark, folder).select(
        "offset", "page_title", "window_start", "matched",
        F.round("similarity_score", 6).alias("similarity_score"), "recent_comments",
    )


@query("""SELECT event_id AS "offset" FROM events WHERE event_type <> 'error' OR event_id % 3 = 2""")
def readable_messages(spark, folder):
    """Messages that are JSON objects, whatever they hold."""
    return sources.decode_json(tables.verdict_messages(spark, folder), "page_title string", keep=["offset"]).select("offset")


_FLAT = with_("verdicts") + """, flat AS (
  SELECT event_id, page_title, window_start, window_end, user_id AS edit_count,
    CAST(CASE WHEN event_type <> 'signup' THEN 3 END AS BIGINT) AS unique_editors,
    CASE WHEN event_type <> 'signup' THEN event_id * 2 END AS total_byte_changes, anomaly_score,
    CASE WHEN has_article THEN 'article ' || event_id END AS news_title,
    CASE WHEN has_article THEN 'u@news' || event_id % 10 || '.example.com:8080' END AS news_domain,
    CASE WHEN has_article THEN 'https://u@news' || event_id % 10 || '.example.com:8080/a?b' || event_id END AS news_url,
    CASE WHEN has_article THEN 'en' END AS news_language,
    CASE WHEN has_article AND event_type <> 'signup' THEN
      strftime(CASE WHEN event_id % 2 = 0 THEN ws ELSE we END, '%Y-%m-%dT%H:%M:%SZ') END AS news_seen_at,
    similarity_score, CASE WHEN event_type <> 'signup' THEN 0.65e0 END AS similarity_threshold, matched,
    CASE WHEN matched THEN '✅ Verified' WHEN similarity_score IS NOT NULL THEN '⚠️ Below threshold'
      ELSE 'No matching article' END AS status, evaluated_at, we, recent_comments
  FROM verdicts)
"""


@query(_FLAT + """SELECT * EXCLUDE (event_id, we, recent_comments) REPLACE (round(similarity_score, 6) AS similarity_score,
  round(anomaly_score, 6) AS anomaly_score) FROM flat""")
def flatten_verdicts(spark, folder):
    flat = verify.flatten_verdicts(_records(spark, folder))
    return flat.withColumns({c: F.round(c, 6) for c in ("similarity_score", "anomaly_score")})


_LATEST = _FLAT + """, latest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY page_title, window_start ORDER BY evaluated_at DESC, event_id DESC) AS rn FROM flat)
  WHERE rn = 1)
"""


def _latest(spark, folder):
    flat = verify.flatten_verdicts(_records(spark, folder), keep=("offset", "recent_comments"))
    return verify.latest_verdicts(flat, ("evaluated_at", "offset"))


@query(_LATEST + """SELECT event_id AS "offset", page_title, window_start, status FROM latest""")
def latest_verdicts(spark, folder):
    return _latest(spark, folder).select("offset", "page_title", "window_start", "status")


@query(_LATEST + """SELECT count(*) AS evaluated, count(*) FILTER (WHERE matched) AS verified,
  count(*) FILTER (WHERE NOT matched AND similarity_score IS NOT NULL) AS below_threshold,
  count(*) FILTER (WHERE similarity_score IS NULL) AS no_candidate,
  round(count(*) FILTER (WHERE matched) / count(*), 6) AS confirmation_rate,
  round(avg(similarity_score) FILTER (WHERE matched), 6) AS average_verified_similarity FROM latest""")
def verdict_summary(spark, folder):
    summary = verify.verdict_summary(_latest(spark, folder))
    return summary.withColumns({
        c: F.round(c, 6) for c in ("confirmation_rate", "average_verified_similarity")
    })


@query(_LATEST + """SELECT page_title, 'https://en.wikipedia.org/wiki/' || page_title AS wikipedia_url, news_url, news_title, news_domain,
    round(similarity_score, 6) AS similarity_score, round(anomaly_score, 6) AS anomaly_score,
    CASE WHEN window_start LIKE '%T%'
      THEN strftime(we - INTERVAL 315 MINUTE, '%b %d %H:%M') || ' – ' || strftime(we - INTERVAL 300 MINUTE, '%H:%M') || ' ET'
      ELSE strftime(we - INTERVAL 15 MINUTE, '%b %d %H:%M') || ' – ' || strftime(we, '%H:%M') || ' ET' END AS "window",
    edit_count, unique_editors, total_byte_changes, coalesce(recent_comments, '') AS recent_comments FROM (
    SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY
      CASE WHEN window_start LIKE '%T%' THEN we ELSE we + INTERVAL 300 MINUTE END DESC, event_id DESC) AS page_rn
    FROM latest WHERE matched) WHERE page_rn = 1""")
def match_table(spark, folder):
    """Confirmed matches, the latest window per page; naive bounds of old messages are Eastern."""
    rows = report.match_table(_latest(spark, folder), ties=[F.desc("offset")])
    return rows.withColumns({c: F.round(c, 6) for c in ("similarity_score", "anomaly_score")})


def _messages(spark, folder):
    """Every readable message; ``complete`` tells whether it carries the required fields."""
    raw = tables.verdict_messages(spark, folder).withColumn("complete", sources.has_keys(F.col("value"), REQUIRED))
    return sources.decode_json(raw, VERDICT_SCHEMA, ["offset", "complete"])


_NEWEST = """newest AS (SELECT event_id, event_type FROM events WHERE event_type <> 'error' OR event_id % 3 = 2
    ORDER BY event_id DESC LIMIT 400)"""


@query(f"""WITH {_NEWEST} SELECT event_id AS "offset" FROM newest WHERE event_type <> 'error'""")
def tail(spark, folder):
    """The last messages; those that lack a field take their place in the tail and are left out after."""
    return report.tail(_messages(spark, folder)).filter("complete").select("offset")


@query(with_("verdicts") + f""", {_NEWEST}, kept AS (
    SELECT * FROM verdicts WHERE matched OR event_id >= (SELECT min(event_id) FROM newest))
  SELECT "offset", page_title, matched FROM (SELECT event_id AS "offset", page_title, matched,
    row_number() OVER (PARTITION BY page_title, window_start, window_end, evaluated_at, similarity_score, matched
      ORDER BY event_id DESC) AS rn FROM kept) WHERE rn = 1""")
def tail_keep_matched(spark, folder):
    rows = report.tail(_messages(spark, folder), keep_matched=True).filter("complete")
    return rows.select("offset", "page_title", "matched")
