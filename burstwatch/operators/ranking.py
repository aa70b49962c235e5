"""Bounded selection per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key with their ``rank``.

    Spark turns ``row_number() <= n`` into a group limit that runs before the
    shuffle as well, so a hot key sends at most ``n`` rows per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return ranked(rows, keys, order, 1).drop("rank")
