"""Instants, minute keys and their display in US Eastern time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from burstwatch.functions.text import strip

# Fixed values.
EASTERN = "America/New_York"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MINUTE_KEY = "yyyyMMddHHmm'00'"


def iso_utc(instant: Column) -> Column:
    return F.date_format(instant, ISO_SECONDS)


def iso_to_epoch(text: Column) -> Column:
    """Epoch seconds of ``2026-08-10T14:30:00Z``; anything else is 0."""
    parsed = F.try_to_timestamp(text, F.lit(ISO_SECONDS))
    return F.coalesce(F.unix_timestamp(parsed), F.lit(0).cast("long"))


def minute_key(instant: Column) -> Column:
    """The file key of a minute; keys sort in time order."""
    return F.date_format(instant, MINUTE_KEY)


def minute_key_to_time(key: Column) -> Column:
    return F.try_to_timestamp(key, F.lit("yyyyMMddHHmmss"))


def to_eastern(instant: Column) -> Column:
    return F.from_utc_timestamp(instant, EASTERN)


def parse_window_time(text: Column) -> Column:
    """Instant of a window bound.

    ISO text (a "T" or a closing "Z") is UTC unless it names an offset. Other
    text with an offset honours it; without one it is an Eastern wall time, as
    older messages carried.
    """
    value = F.nullif(strip(text), F.lit(""))
    parsed = F.try_to_timestamp(value)
    zoned = value.endswith("Z") | value.contains("T") | value.rlike(r":\d{2}(?:\.\d+)? ?[+-]\d{2}(?::?\d{2})?$")
    return F.when(zoned, parsed).otherwise(F.to_utc_timestamp(parsed, EASTERN))


def format_eastern(instant: Column, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    return F.concat(F.date_format(to_eastern(instant), pattern), F.lit(" ET"))


def window_label(start: Column, end: Column) -> Column:
    """``Aug 10 10:30 – 10:45 ET``; unreadable bounds are shown as they are."""
    first, last = parse_window_time(start), parse_window_time(end)
    label = F.concat(
        F.date_format(to_eastern(first), "MMM dd HH:mm"),
        F.lit(" – "),
        format_eastern(last, "HH:mm"),
    )
    start, end = F.nullif(start, F.lit("")), F.nullif(end, F.lit(""))
    raw = F.concat(F.coalesce(start, F.lit("?")), F.lit(" – "), F.coalesce(end, F.lit("?")))
    return F.coalesce(label, F.when(start.isNotNull() | end.isNotNull(), raw))
