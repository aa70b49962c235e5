"""Exact quantiles with bounded memory."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F

from burstwatch.session import cut_lineage

# Rank error of the bracketing sketch is at most n / ACCURACY.
ACCURACY = 100_000
MARGIN = 2.0 / ACCURACY
# Parts that a bracket is cut into while a rank is closed in on.
PARTS = 256


def exact_quantiles(
    rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Quantiles with linear interpolation between neighbours, nulls ignored.

    Spark's exact ``percentile`` keeps every distinct value of a column in one
    task. Here a fixed-size sketch first brackets each wanted rank; a second pass
    counts what lies below a bracket and groups the values inside it, a fraction
    of about 4 / ACCURACY of the rows, with repeated values collapsed before the
    shuffle. Only a few numbers per (column, probability) reach the driver.
    """
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
    bounds = [p for q in probabilities for p in (max(q - MARGIN, 0.0), min(q + MARGIN, 1.0))]
    sketch = values.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.percentile_approx(c, bounds, ACCURACY).alias(f"b_{c}") for c in columns],
    ).first()
    if any(sketch[f"n_{c}"] == 0 for c in columns):
        raise ValueError("no values to take quantiles of")
    brackets = [
        (c, *sketch[f"b_{c}"][2 * i:2 * i + 2], q * (sketch[f"n_{c}"] - 1))
        for c in columns
        for i, q in enumerate(probabilities)
    ]
    placed = _against(values, columns, brackets)
    outside = _outside(placed)
    # A bracket of one value, as with many ties, needs no second look.
    inside = _inside(placed, brackets, outside) if any(low < high for _, low, high, _ in brackets) else {}
    result: dict[str, list[float]] = {c: [] for c in columns}
    for slot, (c, only, _, rank) in enumerate(brackets):
        around, edge = inside.get(slot, {"low": only, "high": only}), outside[slot]
        neighbours = []
        for side, at in (("low", math.floor(rank)), ("high", math.ceil(rank))):
            if edge["below"] <= at < edge["below"] + edge["size"]:
                neighbours.append(around[side])
            elif at in (edge["below"] - 1, edge["below"] + edge["size"]):
                neighbours.append(edge["before"] if at < edge["below"] else edge["after"])
            else:
                raise RuntimeError(f"quantile bracket of {c} missed rank {at}")
        low, high = neighbours
        result[c].append(low + (high - low) * (rank - math.floor(rank)))
    return result


def _against(values: DataFrame, columns: Sequence[str], brackets: list[tuple]) -> DataFrame:
    """Every value beside every bracket of its column: ``slot, low, high, value``.

    Long rows instead of wide aggregates: the generated code stays small, and the
    rows are combined per slot before any shuffle.
    """
    table = F.array(*[
        F.struct(
            F.lit(slot).alias("slot"), F.lit(columns.index(c)).alias("at"),
            F.lit(low).alias("low"), F.lit(high).alias("high"),
        )
        for slot, (c, low, high, _) in enumerate(brackets)
    ])
    rows = values.select(F.array(*columns).alias("all"), F.inline(table))
    return rows.select("slot", "low", "high", F.get("all", F.col("at")).alias("value"))


def _outside(placed: DataFrame) -> dict[int, Row]:
    """Per bracket: how many values lie below and in it, and the nearest value on either side."""
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    found = placed.groupBy("slot").agg(
        F.count_if(value < low).alias("below"),
        F.count_if(value.between(low, high)).alias("size"),
        F.max(F.when(value < low, value)).alias("before"),
        F.min(F.when(value > high, value)).alias("after"),
    )
    return {r["slot"]: r for r in found.collect()}


def _inside(placed: DataFrame, brackets: list[tuple], outside: dict[int, Row]) -> dict[int, dict[str, float]]:
    """Per open bracket: the values at the two ranks around the wanted one.

    The distinct values inside are counted once and stored. A rank is then closed in on:
    its bracket is cut into ``PARTS`` equal parts, whose counts are at most so many rows a rank, and the
    part that holds the rank is the next bracket, until all its values are the same. No
    bracket's values are ever put in order, so none has to fit one task.
    """
    counts = cut_lineage(
        placed.filter("low < high AND value BETWEEN low AND high")
        .groupBy("slot", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # (slot, side) -> bounds, and the rank among the values from the lower bound on
    wanted = {
        (slot, side): (low, high, rounded(rank) - outside[slot]["below"])
        for slot, (_, low, high, rank) in enumerate(brackets) if low < high
        for side, rounded in (("low", math.floor), ("high", math.ceil))
    }
    found: dict[int, dict[str, float]] = {}
    for slot, _ in wanted:
        found.setdefault(slot, {"low": None, "high": None})
    while wanted:
        part = _parts(counts, wanted)
        following = {}
        for (slot, side), (_, _, rank) in wanted.items():
            rows = part.get((slot, side), [])
            for row in rows:  # in order
                if rank < row["n"]:
                    if row["least"] == row["most"]:
                        found[slot][side] = row["least"]
                    elif rank >= 0:
                        following[slot, side] = (row["least"], row["most"], rank)
                    break
                rank -= row["n"]
        wanted = following
    return found


def _parts(counts: DataFrame, wanted: dict[tuple[int, str], tuple]) -> dict[tuple[int, str], list[Row]]:
    """Per rank: how many values each part of its bracket holds, and the least and the greatest of them."""
    table = F.array(*[
        F.struct(
            F.lit(slot).alias("of"), F.lit(side).alias("side"), F.lit(low).cast("double").alias("low"), F.lit(high).cast("double").alias("high")
        )
        for (slot, side), (low, high, _) in wanted.items()
    ])
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    near = counts.select("*", F.inline(F.filter(table, lambda w: w["of"] == F.col("slot")))).filter(value.between(low, high))
    # halves of each, so that the width of a bracket does not overflow
    place = F.floor((value / 2 - low / 2) / (high / 2 - low / 2) * PARTS)
    rows = near.groupBy("slot", "side", F.least(place, F.lit(PARTS - 1)).alias("part")).agg(
        F.sum("n").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")
    ).collect()
    found: dict[tuple[int, str], list[Row]] = {}
    for row in sorted(rows, key=lambda r: r["part"]):
        found.setdefault((row["slot"], row["side"]), []).append(row)
    return found
