"""Training the detector from history or from the feature lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from burstwatch import sources
from burstwatch.operators import detect, edits, features


def history_features(spark: SparkSession, path: str) -> DataFrame:
    """Features per (15-minute window, page) of a history file or folder."""
    records = edits.normalize_history(edits.require_history(sources.read_history(spark, path)))
    return features.tumbling(edits.with_event_time(records))


def train(
    spark: SparkSession,
    history: str | None = None,
    feature_lake: str | None = None,
    model_path: str | None = None,
) -> tuple[detect.IsolationForest, DataFrame]:
    """Fit on one of the two inputs, save the model, and return it with its training rows."""
    if (history is None) == (feature_lake is None):
        raise ValueError("give either a history or a feature lake")
    rows = history_features(spark, history) if history else sources.read_feature_lake(spark, feature_lake)
    model = detect.IsolationForest.fit(rows)
    model.save(spark, detect.resolve_model_path(model_path))
    return model, rows
