"""Scaling, scoring and alerting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.functions.times import iso_utc
from burstwatch.operators.forest import IsolationForest, resolve_model_path
from burstwatch.operators.quantiles import exact_quantiles
from burstwatch.operators.ranking import first_per_key
from burstwatch.schemas import FEATURES
from burstwatch.session import cut_lineage

__all__ = [
    "IsolationForest", "alerts", "label", "one_per_page", "resolve_model_path",
    "robust_scale", "score_lake",
]


def robust_scale(rows: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Center each column on its median and divide by its interquartile range.

    A column whose range is 0 is only centered. Spark ML's scaler would turn it
    into zeros, and most pages have a single edit per window. The rows are read
    several times, so they are checkpointed first.
    """
    rows = cut_lineage(rows)
    quartiles = exact_quantiles(rows, columns, [0.25, 0.5, 0.75])
    scaled = {}
    for name in columns:
        low, middle, high = quartiles[name]
        scaled[name] = (F.col(name) - F.lit(middle)) / F.lit((high - low) or 1.0)
    return rows.withColumns(scaled)


def alerts(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """Windows scoring strictly below 0, times as ISO-8601 UTC text."""
    comments = (
        F.coalesce("recent_comments", F.lit("")) if "recent_comments" in scored.columns else F.lit("")
    )
    return scored.filter(F.col(score) < 0.0).select(
        "page_title",
        iso_utc(F.col("window.start")).alias("window_start"),
        iso_utc(F.col("window.end")).alias("window_end"),
        iso_utc(F.col("last_edit_time")).alias("last_edit_time"),
        "edit_count",
        "unique_editors",
        "total_byte_changes",
        F.col(score).alias("anomaly_score"),
        comments.alias("recent_comments"),
    )


def label(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    return scored.withColumn("is_anomaly", (F.col(score) < 0).cast("int"))


def one_per_page(rows: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """One row per page: the first by ``order``, or any when no order is given."""
    if order is None:
        return rows.dropDuplicates(["page_title"])
    return first_per_key(rows, ["page_title"], order)


def score_lake(
    rows: DataFrame, model: IsolationForest, order: Sequence[Column] | None = None
) -> DataFrame:
    """Score and label the feature lake: one row per page first, then complete rows only."""
    return label(model.score(one_per_page(rows, order).na.drop()))
