"""The report tables over edits, anomalies, verdicts and news."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.functions.times import (
    format_eastern, parse_window_time, to_eastern, window_label,
)
from burstwatch.functions.web import page_url, url_domain
from burstwatch.operators.ranking import first_per_key

# Fixed values.
TOP = 10
LATEST = 100
TAIL = 400
NEWS_TAIL = 25
ACTIVITY_HOURS = 6
VERDICT_KEY = (
    "page_title", "window_start", "window_end", "evaluated_at", "similarity_score", "matched"
)


def tail(
    messages: DataFrame,
    order: Sequence[str] = ("offset",),
    n: int = TAIL,
    keep_matched: bool = False,
    key: Sequence[str] = VERDICT_KEY,
) -> DataFrame:
    """The last ``n`` messages; ``keep_matched`` adds every matched one, later copies winning.

    The bound of the tail is found by a top-n and applied as a filter, so the
    union costs one more scan and no global sort.
    """
    newest = messages.orderBy(*[F.desc(c) for c in order]).limit(n)
    if not keep_matched:
        return newest
    position = F.struct(*[F.col(c) for c in order])
    bound = newest.agg(F.min(position)).scalar()
    kept = messages.filter((position >= bound) | F.coalesce("matched", F.lit(False)))
    return first_per_key(kept, list(key), [F.desc(c) for c in order])


def news_tail(articles: DataFrame, order: Sequence[Column], n: int = NEWS_TAIL) -> DataFrame:
    """The first ``n`` articles by ``order``, newest ``gdelt_seen_at`` first."""
    first = articles.orderBy(*order).limit(n)
    return first.orderBy(F.desc(F.coalesce("gdelt_seen_at", F.lit(""))), *order)


def edit_summary(edits: DataFrame) -> DataFrame:
    bots, minors = (F.count_if(F.coalesce(F.col(c), F.lit(False))) for c in ("bot", "minor"))
    total = F.count(F.lit(1))
    return edits.agg(
        total.alias("total_edits"),
        (total - bots).alias("human_edits"),
        bots.alias("bot_edits"),
        minors.alias("minor_edits"),
        F.coalesce(F.sum("byte_change"), F.lit(0)).alias("net_byte_change"),
    )


def edits_per_minute(edits: DataFrame, hours: int = ACTIVITY_HOURS) -> DataFrame:
    """Edits per active minute over the last hours before the latest edit.

    The bound is one scalar and is compared with the stored ``timestamp`` where
    there is one, so that it reaches the Parquet scan and skips old row groups.
    """
    if "timestamp" in edits.columns:
        time, span = F.col("timestamp"), F.lit(hours * 3600)
    else:
        time, span = F.col("event_time"), F.make_dt_interval(hours=F.lit(hours))
    start = edits.agg(F.max(time) - span).scalar()
    return (
        edits.filter(time >= start)
        .groupBy(F.date_trunc("minute", "event_time").alias("minute"))
        .agg(F.count(F.lit(1)).alias("edits_per_minute"))
        .orderBy("minute")
    )


def _top(edits: DataFrame, column: str, n: int) -> DataFrame:
    return (
        edits.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("edits"))
        .orderBy(F.desc("edits"), column)
        .limit(n)
    )


def top_pages(edits: DataFrame, n: int = TOP) -> DataFrame:
    return _top(edits, "page_title", n)


def top_users(edits: DataFrame, n: int = TOP) -> DataFrame:
    return _top(edits, "user", n)


_CHANGE_COLUMNS = ("page_title", "user", "bot", "byte_change")


def largest_additions(edits: DataFrame, n: int = TOP, ties: Sequence[str] = ("event_id",)) -> DataFrame:
    largest = edits.filter("byte_change > 0").orderBy(F.desc("byte_change"), *ties).limit(n)
    return largest.select(format_eastern(F.col("event_time")).alias("time_et"), *_CHANGE_COLUMNS)


def largest_removals(edits: DataFrame, n: int = TOP, ties: Sequence[str] = ("event_id",)) -> DataFrame:
    largest = edits.filter("byte_change < 0").orderBy(F.asc("byte_change"), *ties).limit(n)
    return largest.select(format_eastern(F.col("event_time")).alias("time_et"), *_CHANGE_COLUMNS)


def latest_edits(edits: DataFrame, n: int = LATEST, ties: Sequence[str] = ("event_id",)) -> DataFrame:
    transport = [c for c in ("partition", "offset") if c in edits.columns]
    latest = edits.orderBy(F.desc_nulls_last("event_time"), *ties).limit(n)
    return latest.select(
        format_eastern(F.col("event_time")).alias("time_et"),
        "page_title", "user", "event_type", "bot", "minor", "byte_change", *transport,
    )


def latest_per_page(rows: DataFrame, time: str, ties: Sequence[Column] = ()) -> DataFrame:
    return first_per_key(rows, ["page_title"], [F.desc_nulls_last(time), *ties])


def fill_last_edit(anomalies: DataFrame, edits: DataFrame) -> DataFrame:
    """Parse the anomalies' times and fill a missing last edit from the edit lake.

    ``sort_ts`` is the last edit, or the window's end where none is known.
    """
    def parsed(column: str) -> Column:
        present = column in anomalies.columns
        return parse_window_time(F.col(column)) if present else F.lit(None).cast("timestamp")

    # Only pages of anomalies without a time of their own need a look into the lake.
    open_pages = anomalies.filter(parsed("last_edit_time").isNull()).select("page_title").distinct()
    last = (
        edits.filter("page_title IS NOT NULL AND event_time IS NOT NULL")
        .join(open_pages, "page_title", "left_semi")
        .groupBy("page_title")
        .agg(F.max("event_time").alias("page_last_edit"))
    )
    return (
        anomalies.withColumn("window_end_ts", parsed("window_end"))
        .withColumn("own_last_edit", parsed("last_edit_time"))
        .join(last, "page_title", "left")
        .withColumn("last_edit_ts", F.coalesce("own_last_edit", "page_last_edit"))
        .withColumn("sort_ts", F.coalesce("last_edit_ts", "window_end_ts"))
        .drop("own_last_edit", "page_last_edit")
    )


def with_comments(rows: DataFrame) -> DataFrame:
    """``recent_comments`` as text, "" where missing or null."""
    value = F.col("recent_comments") if "recent_comments" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("recent_comments", F.coalesce(value, F.lit("")))


def alert_table(
    anomalies: DataFrame, edits: DataFrame, pattern: str | None = None, ties: Sequence[Column] = ()
) -> DataFrame:
    """The alerts page: the latest row per page, newest first, optionally filtered by title."""
    pages = latest_per_page(fill_last_edit(with_comments(anomalies), edits), "sort_ts", ties)
    if pattern:
        pages = search(pages, "page_title", pattern)
    shown = F.date_format(to_eastern(F.col("last_edit_ts")), "yyyy-MM-dd HH:mm:ss")
    return pages.orderBy(F.desc_nulls_last("sort_ts"), "page_title").select(
        "page_title",
        page_url(F.col("page_title")).alias("wikipedia_url"),
        F.coalesce(F.concat(shown, F.lit(" ET")), F.lit("—")).alias("last_edit_display"),
        "anomaly_score", "edit_count", "unique_editors", "total_byte_changes", "recent_comments",
    )


def alert_summary(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        F.count_distinct("page_title").alias("unique_pages"),
        F.count(F.lit(1)).alias("messages_read"),
    )


def match_table(verdicts: DataFrame, ties: Sequence[Column] = ()) -> DataFrame:
    """Confirmed matches out of flattened verdicts: the latest window per page, newest first."""
    matched = with_comments(verdicts.filter("matched")).withColumn(
        "window_end_ts", parse_window_time(F.col("window_end"))
    )
    latest = latest_per_page(matched, "window_end_ts", ties)
    return latest.orderBy(F.desc_nulls_last("window_end_ts"), "page_title").select(
        "page_title",
        page_url(F.col("page_title")).alias("wikipedia_url"),
        "news_url", "news_title", "news_domain", "similarity_score", "anomaly_score",
        window_label(F.col("window_start"), F.col("window_end")).alias("window"),
        "edit_count", "unique_editors", "total_byte_changes", "recent_comments",
    )


def news_table(articles: DataFrame, pattern: str | None = None) -> DataFrame:
    """The news page: newest first, times in Eastern, optionally filtered by title."""
    rows = search(articles, "title", pattern) if pattern else articles
    seen, observed = (F.try_to_timestamp(F.col(c)) for c in ("gdelt_seen_at", "observed_at"))
    return (
        rows.withColumn("observed_ts", observed)
        .orderBy(F.desc_nulls_last("observed_ts"), "event_id")
        .select(
            "title", url_domain(F.col("url")).alias("domain"), "language",
            format_eastern(seen).alias("gdelt_seen_at"),
            format_eastern(F.col("observed_ts")).alias("observed_at"),
            "url",
        )
    )


def search(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text contains a match of the pattern, upper and lower case alike."""
    return rows.filter(F.col(column).rlike("(?iu)" + pattern))


def languages(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy(F.coalesce(F.nullif("language", F.lit("")), F.lit("unknown")).alias("language"))
        .agg(F.count(F.lit(1)).alias("articles"))
        .orderBy(F.desc("articles"), "language")
    )


def training_summary(features: DataFrame) -> DataFrame:
    """Samples and distinct pages of the complete training rows."""
    return features.na.drop().agg(
        F.count(F.lit(1)).alias("samples"), F.count_distinct("page_title").alias("distinct_pages")
    )


def training_sample(features: DataFrame, order: Sequence[Column], n: int = TOP) -> DataFrame:
    """One row for each of the first ``n`` pages, from the complete training rows."""
    pages = first_per_key(features.na.drop(), ["page_title"], order)
    return pages.orderBy("page_title").limit(n).select("page_title", "edit_count", "total_byte_changes")


def training_distribution(features: DataFrame, score: str | None = None) -> DataFrame:
    """Share of single-edit rows and, for scored rows, the share that is flagged."""
    def share(condition: Column) -> Column:
        return F.avg(condition.cast("double"))

    measures = [F.count(F.lit(1)).alias("rows"), share(F.col("edit_count") == 1).alias("single_edit_share")]
    if score:
        measures.append(share(F.col(score) < 0).alias("flagged_share"))
    return features.agg(*measures)


def dataset_info(lake: DataFrame) -> DataFrame:
    """Files, records and column names of a file-backed table.

    Only per-file counts are shuffled, so a hot file costs one row per task.
    """
    names = [c for c in lake.columns]
    per_file = lake.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.count("file").alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.lit(",".join(names)).alias("columns"),
    )


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Tables stacked by column name; a column missing in one reads null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
