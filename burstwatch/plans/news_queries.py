"""The news side: decoding, snippets, normalizing, scope, duplicates, pending minutes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from burstwatch import sources
from burstwatch.functions import minute_key
from burstwatch.operators import news, report
from burstwatch.plans import tables
from burstwatch.plans.registry import query
from burstwatch.plans.tables import with_
from burstwatch.sources import sinks


@query(with_("toc") + """SELECT "ID", "date", img, lang, title, url, toc_timestamp, pos FROM toc
  WHERE lang NOT IN ('es', 'de')""")
def decode_toc(spark, folder):
    return sources.decode_toc(tables.toc_lines(spark, folder))


@query("""SELECT conv_id AS docid, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS quadgram, length(text) AS "count"
  FROM conversations WHERE turn % 5 = 0 AND trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''""")
def decode_ngrams(spark, folder):
    return sources.decode_ngrams(tables.ngram_lines(spark, folder), keep=())


@query(with_("ngrams", "snippets") + "SELECT docid, snippet FROM snippets")
def build_snippets(spark, folder):
    return news.build_snippets(tables.ngrams(spark, folder, ("docid",)))


@query(with_("toc", "ngrams", "snippets") + """SELECT t."ID", t.toc_timestamp, coalesce(s.snippet, '') AS snippet
  FROM toc t LEFT JOIN snippets s ON s.docid = t."ID" AND s.toc_timestamp = t.toc_timestamp""")
def attach_snippets(spark, folder):
    snippets = news.build_snippets(tables.ngrams(spark, folder), ("toc_timestamp", "docid"))
    return news.attach_snippets(tables.toc(spark, folder), snippets).select("ID", "toc_timestamp", "snippet")


_ARTICLE_COLUMNS = "event_id, toc_id, toc_timestamp, gdelt_seen_at, title, url, language, image_url, source, event_type"


@query(with_("toc", "articles") + f"SELECT {_ARTICLE_COLUMNS} FROM articles")
def normalize_news(spark, folder):
    return news.normalize(tables.toc(spark, folder)).drop("snippet", "observed_at")


@query(with_("toc", "articles") + "SELECT event_id, toc_id, language FROM articles WHERE language IN ('en', 'fr')")
def in_languages(spark, folder):
    wanted = news.parse_languages(" EN, fr ,,en")
    articles = news.normalize(tables.toc(spark, folder))
    return news.in_languages(articles, wanted).select("event_id", "toc_id", "language")


@query(with_("toc", "articles") + """SELECT event_id, toc_id, title FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY toc_timestamp, pos) AS rn FROM articles) WHERE rn = 1""")
def dedup_news(spark, folder):
    articles = news.normalize(tables.toc(spark, folder), keep=("pos",))
    return news.dedup(articles).select("event_id", "toc_id", "title")


@query(with_("toc", "articles", "ngrams", "snippets") + """, one AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY toc_timestamp, pos) AS rn
    FROM articles WHERE language = 'en') WHERE rn = 1)
  SELECT event_id AS key, to_json({event_id: event_id, toc_id: toc_id, title: title, url: url,
    image_url: image_url, snippet: coalesce(s.snippet, '')})::VARCHAR AS value
  FROM one LEFT JOIN snippets s ON s.docid = one.toc_id AND s.toc_timestamp = one.toc_timestamp""")
def news_events(spark, folder):
    """The whole news job on tables: snippets, normalizing, scope, first per URL, keyed JSON."""
    articles = news.assemble(tables.toc(spark, folder), tables.ngrams(spark, folder), ("en",))
    shown = articles.select("event_id", "toc_id", "title", "url", "image_url", "snippet")
    return sinks.keyed_json(shown, "event_id", ignore_nulls=False)


@query("""WITH ledger AS (SELECT DISTINCT strftime(ts, '%Y%m%d%H%M00') AS k FROM events)
  SELECT strftime(m, '%Y%m%d%H%M00') AS toc_timestamp
  FROM range(TIMESTAMP '2024-01-14 23:10:00', TIMESTAMP '2024-01-15 00:00:01', INTERVAL 1 MINUTE) r(m)
  WHERE strftime(m, '%Y%m%d%H%M00') NOT IN (SELECT k FROM ledger)""")
def pending_minutes(spark, folder):
    """Minutes without any event yet, seen from five past midnight."""
    done = tables.edits(spark, folder).select(minute_key(F.col("event_time")).alias("toc_timestamp"))
    return news.pending_minutes(spark, datetime(2024, 1, 15, 0, 5, 30), done, lookback=50)


@query("""SELECT DISTINCT strftime(ts, '%Y%m%d%H%M00') AS toc_timestamp FROM events
  WHERE strftime(ts, '%Y%m%d%H%M00') >= '20240114210500'""")
def prune_ledger(spark, folder):
    done = tables.edits(spark, folder).select(minute_key(F.col("event_time")).alias("toc_timestamp"))
    return news.prune_ledger(done.distinct(), datetime(2024, 1, 15, 0, 5, 30))


@query("""SELECT coalesce(nullif(lang, ''), 'unknown') AS language, count(*) AS articles FROM documents GROUP BY 1""")
def languages(spark, folder):
    return report.languages(tables.toc(spark, folder).withColumnRenamed("lang", "language"))


@query(with_("toc", "articles") + """SELECT event_id, toc_id, gdelt_seen_at, title FROM (
  SELECT * FROM articles ORDER BY toc_timestamp, toc_id LIMIT 25)""")
def news_tail(spark, folder):
    articles = news.normalize(tables.toc(spark, folder))
    tail = report.news_tail(articles, [F.asc("toc_timestamp"), F.asc("toc_id")])
    return tail.select("event_id", "toc_id", "gdelt_seen_at", "title")


@query(with_("toc", "articles") + r"""SELECT title, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain, language,
  strftime(strptime(gdelt_seen_at, '%Y-%m-%dT%H:%M:%S.000Z') - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M ET') AS gdelt_seen_at, url
  FROM articles WHERE regexp_matches(title, '(?i)th(e|an)\b')""")
def news_table(spark, folder):
    articles = news.normalize(tables.toc(spark, folder))
    return report.news_table(articles, r"TH(e|an)\b").drop("observed_at")
