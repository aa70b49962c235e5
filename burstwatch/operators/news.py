"""News articles: snippets, normalizing, scope and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from burstwatch.functions.text import blank_to_null, edge_trim, strip
from burstwatch.functions.times import minute_key
from burstwatch.functions.web import stable_id
from burstwatch.operators.ranking import first_per_key, ranked

# Fixed values.
SOURCE = "gdelt_web_ngrams"
EVENT_TYPE = "article"
SNIPPET_QUADGRAMS = 5
LOOKBACK_MINUTES = 45
DELAY_MINUTES = 5
LEDGER_MINUTES = 180
KEY_FORMAT = "%Y%m%d%H%M00"


def quadgram_totals(ngrams: DataFrame, keys: Sequence[str] = ("docid",)) -> DataFrame:
    """Counts per (document, cleaned quadgram) with the position it first appeared at."""
    return (
        ngrams.withColumn("quadgram", edge_trim(F.col("quadgram")))
        .filter("quadgram <> ''")
        .groupBy(*keys, "quadgram")
        .agg(F.sum("count").alias("total"), F.min("pos").alias("first_pos"))
    )


def build_snippets(
    ngrams: DataFrame, keys: Sequence[str] = ("docid",), n: int = SNIPPET_QUADGRAMS
) -> DataFrame:
    """One ``snippet`` per document: its ``n`` most frequent quadgrams, ties by first appearance."""
    order = [F.desc("total"), F.asc("first_pos")]
    top = ranked(quadgram_totals(ngrams, keys), keys, order, n)
    in_order = F.sort_array(F.collect_list(F.struct("rank", "quadgram")))
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(in_order, lambda q: q["quadgram"]), " ").alias("snippet")
    )


def attach_snippets(entries: DataFrame, snippets: DataFrame) -> DataFrame:
    """Entries with the ``snippet`` of the same minute and document; "" where there is none."""
    matched = (entries["toc_timestamp"] == snippets["toc_timestamp"]) & (
        entries["ID"] == snippets["docid"]
    )
    return entries.join(snippets, matched, "left").select(
        *[entries[c] for c in entries.columns],
        F.coalesce(snippets["snippet"], F.lit("")).alias("snippet"),
    )


def normalize(entries: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Entries (with ``toc_timestamp`` and, if known, ``snippet``) as article events."""
    url, title = strip(F.col("url")), strip(F.col("title"))
    snippet = F.coalesce("snippet", F.lit("")) if "snippet" in entries.columns else F.lit("")
    return entries.filter((url != "") & (title != "")).select(
        stable_id(F.col("url")).alias("event_id"),
        F.col("ID").alias("toc_id"),
        "toc_timestamp",
        F.col("date").alias("gdelt_seen_at"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("observed_at"),
        title.alias("title"),
        url.alias("url"),
        F.col("lang").alias("language"),
        F.nullif("img", F.lit("")).alias("image_url"),
        snippet.alias("snippet"),
        F.lit(SOURCE).alias("source"),
        F.lit(EVENT_TYPE).alias("event_type"),
        *keep,
    )


def parse_languages(text: str | None) -> tuple[str, ...]:
    """Distinct lower-case codes of a comma-separated list, in their order; blanks are skipped."""
    codes = (part.strip().lower() for part in (text or "").split(","))
    return tuple(dict.fromkeys(code for code in codes if code))


def in_languages(articles: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Articles in one of the languages; no language given means all pass."""
    if not languages:
        return articles
    return articles.filter(F.lower(F.coalesce(blank_to_null(F.col("language")), F.lit(""))).isin(*languages))


def dedup(articles: DataFrame, order: Sequence[str] = ("toc_timestamp", "pos")) -> DataFrame:
    """The first article of each ``event_id``."""
    return first_per_key(articles, ["event_id"], [F.asc(c) for c in order])


def dedup_stream(articles: DataFrame, time: str, within: str = "24 hours") -> DataFrame:
    """The stream form: an id seen again within the time bound is dropped."""
    return articles.withWatermark(time, within).dropDuplicatesWithinWatermark(["event_id"])


def pending_minutes(
    spark: SparkSession,
    now: datetime,
    ledger: DataFrame,
    lookback: int = LOOKBACK_MINUTES,
    delay: int = DELAY_MINUTES,
) -> DataFrame:
    """Minute keys from ``now - delay - lookback`` to ``now - delay`` (UTC) that ``ledger`` lacks."""
    last = now.replace(second=0, microsecond=0) - timedelta(minutes=delay)
    first = last - timedelta(minutes=lookback)
    steps = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MINUTE"))
    wanted = spark.range(1).select(F.explode(steps).alias("minute"))
    wanted = wanted.select(minute_key(F.col("minute")).alias("toc_timestamp"))
    # Plain bounds reach the ledger's scan; what is left has lookback + 1 distinct keys at most.
    done = ledger.filter(F.col("toc_timestamp").between(*(t.strftime(KEY_FORMAT) for t in (first, last))))
    return wanted.join(done.select("toc_timestamp").distinct(), "toc_timestamp", "left_anti")


def prune_ledger(ledger: DataFrame, now: datetime, keep_minutes: int = LEDGER_MINUTES) -> DataFrame:
    """Ledger entries not older than ``keep_minutes``, whole minutes compared as keys."""
    cutoff = (now - timedelta(minutes=keep_minutes)).strftime(KEY_FORMAT)
    return ledger.filter(F.col("toc_timestamp") >= cutoff)


def assemble(toc: DataFrame, ngrams: DataFrame, languages: Sequence[str] = ()) -> DataFrame:
    """Article events of the given minutes: normalized, in scope, first per URL, with their snippets.

    Quadgrams are counted for the articles that are left, and only for those. The articles' keys are
    hashed in parts, so quadgrams that lie by minute and document are neither moved nor put in order for it.
    """
    articles = dedup(in_languages(normalize(toc.drop("snippet"), keep=("pos",)), languages)).drop("pos")
    asked = articles.select("toc_timestamp", F.col("toc_id").alias("docid")).distinct().hint("shuffle_hash")
    snippets = build_snippets(ngrams.join(asked, ["toc_timestamp", "docid"], "left_semi"), ("toc_timestamp", "docid"))
    own = articles.drop("snippet").join(
        snippets.withColumnRenamed("docid", "toc_id"), ["toc_timestamp", "toc_id"], "left"
    ).withColumn("snippet", F.coalesce("snippet", F.lit("")))
    return own.select(*articles.columns)
