"""Matching anomalies with news, and the verdicts that come of it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from burstwatch.functions.text import anomaly_text, article_text
from burstwatch.functions.web import url_domain
from burstwatch.operators.nearest import RETENTION, nearest_news
from burstwatch.operators.ranking import first_per_key
from burstwatch.schemas import ARTICLE_FIELDS

# Fixed values.
THRESHOLD = 0.65
STATUS_VERIFIED = "✅ Verified"
STATUS_BELOW = "⚠️ Below threshold"
STATUS_NO_CANDIDATE = "No matching article"

DIMENSIONS = 384

# Adds the vector of a text column: (rows, text column, vector column) -> rows.
Embedder = Callable[[DataFrame, str, str], DataFrame]


# Words are counted by this many slots, so a table of their weights does not grow with the vocabulary.
SLOTS = 2**18
_DIGEST_DIGITS = 15


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _digest(word: Column) -> Column:
    """60 bits of the word's md5."""
    return F.conv(F.substring(F.md5(word), 1, _DIGEST_DIGITS), 16, 10).cast("bigint")


class HashedTextEmbedder:
    """The built-in embedder: hashed words, weighted by rarity once fitted, unit length.

    A word's md5 gives its slot (for the weight), its place among the dimensions and its sign there,
    so that words that share a place do not add up. A slot weighs ln((texts + 1) / (texts with it + 1)).
    Any callable of the same shape can take its place, for instance one that
    wraps a ``pandas_udf`` around a neural encoder.
    """

    def __init__(self, dimensions: int = DIMENSIONS, weights: np.ndarray | None = None):
        self.dimensions, self.weights = dimensions, weights

    def fit(self, rows: DataFrame, text: str) -> "HashedTextEmbedder":
        """Learn weights from a corpus; keep the result to embed later texts alike.

        Null and wordless texts count as texts. At most ``SLOTS`` numbers reach the driver.
        """
        slots = F.array_distinct(F.transform(_words(F.col(text)), lambda w: F.pmod(_digest(w), F.lit(SLOTS))))
        # The row without a slot counts the texts, in the same pass.
        each = rows.select(F.explode(F.array_append(F.coalesce(slots, F.array().cast("array<bigint>")), F.lit(-1))).alias("slot"))
        held = each.groupBy("slot").agg(F.count("*").alias("n")).toPandas()
        found = np.zeros(SLOTS + 1)
        found[held["slot"].to_numpy(dtype=np.int64)] = held["n"]
        return HashedTextEmbedder(self.dimensions, np.log((found[-1] + 1) / (found[:-1] + 1)))

    def __call__(self, rows: DataFrame, text: str, vector: str) -> DataFrame:
        dimensions, weights = self.dimensions, self.weights

        @F.pandas_udf("array<float>")
        def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for digests in batches:
                counts = digests.map(len).to_numpy()
                found = np.concatenate([*digests, np.empty(0, dtype=np.int64)])
                signed = np.where(found // SLOTS // dimensions % 2 == 0, 1.0, -1.0)
                if weights is not None:
                    signed *= weights[found % SLOTS]
                at = np.repeat(np.arange(len(counts)), counts) * dimensions + found // SLOTS % dimensions
                sums = np.bincount(at, signed, len(counts) * dimensions).reshape(-1, dimensions)
                length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
                yield pd.Series(list((sums / np.where(length > 0, length, 1.0)).astype(np.float32)))

        digests = F.transform(_words(F.coalesce(F.col(text), F.lit(""))), _digest)
        return rows.withColumn(vector, place(digests))

    def save(self, spark: SparkSession, path: str) -> None:
        """The weights as a table ``slot, weight``."""
        if self.weights is None:
            raise ValueError("nothing was fitted")
        table = pd.DataFrame({"slot": np.arange(SLOTS), "weight": self.weights, "dimensions": self.dimensions})
        spark.createDataFrame(table, "slot int, weight double, dimensions int").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "HashedTextEmbedder":
        table = spark.read.parquet(path).toPandas().sort_values("slot")
        return cls(int(table["dimensions"].iloc[0]), table["weight"].to_numpy())


def embed(rows: DataFrame, text: str, vector: str = "embedding", embedder: Embedder | None = None) -> DataFrame:
    """Unit-length vectors of a text column; blank text has none."""
    embedded = (embedder or HashedTextEmbedder())(rows, text, vector)
    return embedded.withColumn(vector, F.when(F.trim(F.col(text)) != "", F.col(vector)))


def embed_articles(news: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Articles with their vector; an article without any text is not indexed."""
    texts = news.withColumn("text", article_text(F.col("title"), F.col("snippet")))
    return embed(texts.filter("text <> ''"), "text", embedder=embedder).drop("text")


def embed_anomalies(anomalies: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    texts = anomalies.withColumn("text", anomaly_text(F.col("page_title"), F.col("recent_comments")))
    return embed(texts, "text", embedder=embedder).drop("text")


def verdicts(
    anomalies: DataFrame,
    news: DataFrame,
    threshold: float = THRESHOLD,
    retention: timedelta = RETENTION,
    evaluated_at: datetime | None = None,
    **search: object,
) -> DataFrame:
    """One verdict per anomaly, matched or not.

    Both sides carry an ``embedding``; anomalies say when they are ``handled_at``
    and articles when they were ``added_at``. A similarity equal to the threshold
    matches. ``closest_article`` is there whenever a candidate was.
    """
    judged = nearest_news(anomalies, news, retention, **search)
    matched = F.coalesce(F.col("similarity_score") >= threshold, F.lit(False))
    article = F.when(
        F.col("article").isNotNull(),
        F.struct(*[F.col(f"article.{name}").alias(name) for name in ARTICLE_FIELDS]),
    )
    instant = F.lit(evaluated_at).cast("timestamp") if evaluated_at else F.current_timestamp()
    return judged.select(
        "page_title", "window_start", "window_end", "anomaly_score", "edit_count",
        "recent_comments", "unique_editors", "total_byte_changes",
        matched.alias("matched"),
        "similarity_score",
        F.lit(float(threshold)).alias("similarity_threshold"),
        F.when(matched, article).alias("matched_article"),
        article.alias("closest_article"),
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("evaluated_at"),
    )


def status(matched: Column, similarity: Column) -> Column:
    return (
        F.when(matched, STATUS_VERIFIED)
        .when(similarity.isNotNull(), STATUS_BELOW)
        .otherwise(STATUS_NO_CANDIDATE)
    )


def flatten_verdicts(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Verdict messages as flat display rows; fields an old message lacks are null."""
    article = F.coalesce("closest_article", "matched_article")
    matched = F.coalesce("matched", F.lit(False))
    rows = records.withColumn("article", article)
    return rows.select(
        "page_title", "window_start", "window_end", "edit_count", "unique_editors",
        "total_byte_changes", "anomaly_score",
        F.col("article.title").alias("news_title"),
        url_domain(F.col("article.url")).alias("news_domain"),
        F.col("article.url").alias("news_url"),
        F.col("article.language").alias("news_language"),
        F.coalesce(F.nullif("article.gdelt_seen_at", F.lit("")), "article.observed_at").alias("news_seen_at"),
        "similarity_score", "similarity_threshold",
        matched.alias("matched"),
        status(matched, F.col("similarity_score")).alias("status"),
        "evaluated_at",
        *keep,
    )


def latest_verdicts(flat: DataFrame, order: tuple[str, ...] = ("evaluated_at",)) -> DataFrame:
    """The last verdict of each (page, window start)."""
    return first_per_key(flat, ["page_title", "window_start"], [F.desc_nulls_last(c) for c in order])


def verdict_summary(latest: DataFrame) -> DataFrame:
    """Counts over every evaluated anomaly, the confirmed share and the mean confirmed similarity."""
    matched, score = F.col("matched"), F.col("similarity_score")
    total, verified = F.count(F.lit(1)), F.count_if(matched)
    return latest.agg(
        total.alias("evaluated"),
        verified.alias("verified"),
        F.count_if(~matched & score.isNotNull()).alias("below_threshold"),
        F.count_if(score.isNull()).alias("no_candidate"),
        F.coalesce(F.try_divide(verified, total), F.lit(0.0)).alias("confirmation_rate"),
        F.avg(F.when(matched, score)).alias("average_verified_similarity"),
    )
