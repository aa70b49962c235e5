"""Per-page activity features over event-time windows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from burstwatch.functions.text import clean_comment, has_content
from burstwatch.operators.ranking import ranked
from burstwatch.session import broadcast_if_small, cut_lineage
from burstwatch.sources.decode import once

# Fixed values.
WINDOW = "15 minutes"
SLIDE = "5 minutes"
WATERMARK = "10 minutes"
SAMPLE_SIZE = 5
SAMPLE_SEPARATOR = " | "


# Registers of the editor sketch, as a power of two. Its relative standard error is 1.04 / sqrt(registers);
# up to a tenth as many editors are counted as good as exactly.
SKETCH = 10


def _sums(count: Column) -> dict[str, Column]:
    """What adds up over parts of a window."""
    return {
        "edit_count": count,
        "total_byte_changes": F.sum(F.abs("byte_change")),
        "bots": F.count_if(F.col("bot")),
        "minors": F.count_if(F.col("minor")),
    }


def _shares(rows: DataFrame) -> DataFrame:
    """Ratios instead of the counts of bots and minor edits."""
    return rows.withColumns({
        "bot_ratio": F.try_divide("bots", "edit_count"), "minor_edit_ratio": F.try_divide("minors", "edit_count"),
    }).drop("bots", "minors")


def _checked(distinct: str) -> str:
    if distinct not in ("approx", "exact"):
        raise ValueError("distinct must be 'approx' or 'exact'")
    return distinct


def _sketch() -> Column:
    """A sketch of the editors that can be merged; the hash lets an empty name count as one."""
    return F.hll_sketch_agg(F.when(F.col("user").isNotNull(), F.xxhash64("user")), F.lit(SKETCH))


def _editors(distinct: str) -> Column:
    if _checked(distinct) == "exact":
        return F.count_distinct("user")
    return F.coalesce(F.hll_sketch_estimate(_sketch()), F.lit(0).cast("long"))


def _whole(rows: DataFrame, keys: Sequence, distinct: str, count: Column, *more: Column) -> DataFrame:
    """Features per key in one aggregation."""
    measures = [c.alias(n) for n, c in _sums(count).items()]
    found = rows.groupBy(*keys).agg(*measures, _editors(distinct).alias("unique_editors"), *more)
    names = [c for c in found.columns if c not in (*_sums(count), "unique_editors", "last_edit_time")]
    last = [c for c in ("last_edit_time",) if c in found.columns]
    return _shares(found).select(
        *names, "edit_count", "unique_editors", "total_byte_changes", "bot_ratio", "minor_edit_ratio", *last
    )


def with_ratios(rows: DataFrame) -> DataFrame:
    """Add the three derived features; missing inputs and empty divisions count as 0."""
    count, editors, size, bots, minors = (
        F.coalesce(c, F.lit(0))
        for c in ("edit_count", "unique_editors", "total_byte_changes", "bot_ratio", "minor_edit_ratio")
    )
    return rows.withColumns({
        "relative_growth": F.coalesce(F.try_divide(size, count), F.lit(0.0)),
        "human_bot_friction": minors - bots,
        "editor_concentration": F.coalesce(F.try_divide(editors, count), F.lit(0.0)),
    })


def sliding(
    events: DataFrame,
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str = WATERMARK,
    distinct: str = "approx",
) -> DataFrame:
    """Features per (sliding window, page): the form that is scored.

    Works on tables and on streams. A stream gets the watermark and must use the
    approximate editor count: its sketch has a fixed size, where an exact count
    would keep every editor of a hot page in one state row. Tables are put together from
    panes, with either count. Spans are intervals of fixed length, such as "15 minutes".
    """
    last = F.max("event_time").alias("last_edit_time")
    if events.isStreaming:
        if _checked(distinct) != "approx":
            raise ValueError("streams support distinct='approx' only")
        events = events.withWatermark("event_time", watermark)
        keys = [F.window("event_time", window, slide), "page_title"]
        return with_ratios(_whole(events, keys, distinct, F.count("event_id"), last))
    return with_ratios(_of_panes(events, window, slide, _checked(distinct)))


def _seconds(span: str) -> int:
    """Length of an interval of fixed length; months and years have none."""
    parts = span.lower().removeprefix("interval ").split()
    return int(sum(timedelta(**{unit.rstrip("s") + "s": float(n)}).total_seconds() for n, unit in zip(parts[::2], parts[1::2])))


def _of_panes(events: DataFrame, window: str, slide: str, distinct: str) -> DataFrame:
    """Sliding windows put together from panes, the longest stretches that no window cuts.

    Edits are aggregated per (page, pane) once; only these rows are repeated for the windows
    that hold them. Editors cannot be added up. Approximate counts merge a sketch per pane.
    Exact ones count an editor in a window at the first of its panes the editor is in: at an
    age of k slides, counted back from the last window that holds the pane, if the editor's
    pane before is older than that window. So each (page, pane, editor) is one row however
    many edits it stands for, and how many editors are new at each age is a sum per pane.
    """
    width, step = _seconds(window), _seconds(slide)
    pane = math.gcd(width, step)
    at = F.floor(F.unix_micros("event_time") / F.lit(pane * 1_000_000)).cast("long").alias("pane")
    sums = _sums(F.count("event_id")) | {"last_edit_time": F.max("event_time")}
    again = {n: F.max(n) if n == "last_edit_time" else F.sum(n) for n in sums}
    timed = events.filter(F.col("event_time").isNotNull()).select("*", at)
    ages = range(-(-width // step))
    # the windows that hold a pane start at the last multiple of the slide and before, one age each
    newest = F.floor(F.col("pane") * pane / step).cast("long") * step
    begins = [newest - k * step for k in ages]
    held = [b + width > F.col("pane") * pane for b in begins]
    if distinct == "exact":
        own = timed.groupBy("page_title", "user", "pane").agg(*[c.alias(n) for n, c in sums.items()])
        before = F.lag("pane").over(Window.partitionBy("page_title", "user").orderBy("pane")) * pane
        known = F.col("user").isNotNull()
        first = [(known & F.coalesce(F.col("before") < b, F.lit(True))).cast("long").alias(f"new_{k}") for k, b in enumerate(begins)]
        own = own.withColumn("before", before).select("*", *first)
        panes = own.groupBy("page_title", "pane").agg(
            *[c.alias(n) for n, c in again.items()], *[F.sum(f"new_{k}").alias(f"new_{k}") for k in ages]
        )
        editors, count = [F.col(f"new_{k}") for k in ages], F.sum("editors")
    else:
        panes = timed.groupBy("page_title", "pane").agg(
            *[c.alias(n) for n, c in sums.items()], _sketch().alias("editors")
        )
        editors = [F.col("editors")] * len(ages)
        count = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("editors")), F.lit(0).cast("long"))
    windows = F.filter(
        F.array(*[F.when(h, F.struct(b.alias("start"), e.alias("editors"))) for b, h, e in zip(begins, held, editors)]),
        lambda w: w.isNotNull(),
    )
    parts = panes.select("page_title", *sums, F.inline(windows))
    found = parts.groupBy("start", "page_title").agg(*[c.alias(n) for n, c in again.items()], count.alias("unique_editors"))
    bounds = F.struct(F.timestamp_seconds("start").alias("start"), F.timestamp_seconds(F.col("start") + width).alias("end"))
    return _shares(found).select(
        bounds.alias("window"), "page_title", "edit_count", "unique_editors", "total_byte_changes", "bot_ratio",
        "minor_edit_ratio", "last_edit_time",
    )


def tumbling(events: DataFrame, window: str = WINDOW, distinct: str = "exact") -> DataFrame:
    """Features per (tumbling window, page): the form the model is trained on.

    Windows are aligned to the epoch; the count is of rows; rows without page are dropped.
    """
    rows = events.filter(F.col("page_title").isNotNull())
    return with_ratios(_whole(rows, [F.window("event_time", window), "page_title"], distinct, F.count(F.lit(1))))


def per_page(
    events: DataFrame, distinct: str = "approx", keys: Sequence[str] = ("page_title",)
) -> DataFrame:
    """Features per page over the whole input, without a time bucket."""
    return with_ratios(_whole(events, keys, distinct, F.count("event_id")))


def comment_sample(
    events: DataFrame,
    keys: Sequence[str],
    n: int = SAMPLE_SIZE,
    order: Sequence[str] = ("event_time", "event_id"),
) -> DataFrame:
    """Up to ``n`` substantive comments per key, earliest first, joined to one text.

    The cut comes before any list is built, so no list grows past ``n``.
    """
    return _first_texts(_candidates(events, [*keys, *order]), keys, n, order)


def _candidates(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The edits with a substantive comment, cleaned once each, as ``candidate``."""
    cleaned = once(F.struct(clean_comment(F.col("comment")).alias("candidate")))
    return events.select(*columns, cleaned).filter(has_content(F.col("candidate")))


def _first_texts(
    candidates: DataFrame, keys: Sequence[str], n: int = SAMPLE_SIZE,
    order: Sequence[str] = ("event_time", "event_id"),
) -> DataFrame:
    chosen = ranked(candidates, keys, [F.col(c) for c in order], n)
    in_order = F.sort_array(F.collect_list(F.struct("rank", "candidate")))
    return chosen.groupBy(*keys).agg(
        F.array_join(F.transform(in_order, lambda c: c["candidate"]), SAMPLE_SEPARATOR)
        .alias("recent_comments")
    )


def attach_comments(
    rows: DataFrame, events: DataFrame, window: str = WINDOW, slide: str = SLIDE
) -> DataFrame:
    """Add ``recent_comments`` to rows keyed by (window, page_title); "" where there is none.

    Meant for the few flagged windows: these are checkpointed and counted, and
    when few enough they are broadcast. Edits are thinned by page and slide-long
    pane first, so that only the edits of flagged windows are cleaned, once each,
    before they are put into their windows and ranked.
    """
    keys = ["window", "page_title"]
    rows = cut_lineage(rows)
    flagged = rows.select(*keys).distinct()
    step = F.expr(f"INTERVAL {slide}")
    panes = F.explode(F.sequence(F.col("window.start"), F.col("window.end") - step, step)).alias("pane")
    touched = broadcast_if_small(flagged.select("page_title", panes).distinct())
    near = events.withColumn("pane", F.window("event_time", slide)["start"]).join(
        touched, ["page_title", "pane"], "left_semi"
    )
    candidates = _candidates(near, ["page_title", "event_time", "event_id"])
    windowed = candidates.withColumn("window", F.window("event_time", window, slide))
    sample = _first_texts(windowed.join(broadcast_if_small(flagged), keys, "left_semi"), keys)
    return rows.join(sample, keys, "left").withColumn(
        "recent_comments", F.coalesce("recent_comments", F.lit(""))
    )
