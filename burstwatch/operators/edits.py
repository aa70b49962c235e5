"""Edit scoping and normalizing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.functions.times import iso_to_epoch
from burstwatch.schemas import CHANGE_FEED_SCHEMA
from burstwatch.sources.decode import once

# Which changes count as article edits.
SERVER = "en.wikipedia.org"
CHANGE_TYPES = ("edit", "new")
ARTICLE_NAMESPACE = 0

REQUIRED_HISTORY = {
    "page_title": ("page_title", "title", "page"),
    "user": ("user", "user_name"),
    "timestamp": ("timestamp", "ts", "time"),
}


def in_scope(feed: DataFrame) -> DataFrame:
    """Changes of the raw feed (``value``) that are article edits, as ``change`` plus its ``keys``.

    ``keys`` lists the object's fields so that an absent flag and a null one stay apart.
    """
    text = F.col("value").cast("string")
    return (
        feed.select(once(F.struct(
            F.from_json(text, CHANGE_FEED_SCHEMA).alias("change"),
            F.json_object_keys(text).alias("keys"),
        )))
        .filter(F.col("change.server_name") == SERVER)
        .filter(F.col("change.type").isin(*CHANGE_TYPES))
        .filter(F.col("change.namespace") == ARTICLE_NAMESPACE)
    )


def normalize(changes: DataFrame) -> DataFrame:
    """Scoped changes as flat edit records."""
    old = F.coalesce("change.length.old", F.lit(0)).cast("long")
    new = F.coalesce("change.length.new", F.lit(0)).cast("long")

    def flag(name: str) -> Column:
        present = F.array_contains("keys", name)
        return F.when(present, F.col(f"change.{name}")).otherwise(F.lit(False)).alias(name)

    return changes.select(
        F.col("change.meta.id").alias("event_id"),
        F.col("change.id").alias("recent_change_id"),
        F.col("change.revision.new").alias("revision_id"),
        "change.timestamp",
        F.col("change.title").alias("page_title"),
        "change.namespace",
        "change.user",
        flag("bot"),
        flag("minor"),
        old.alias("old_length"),
        new.alias("new_length"),
        (new - old).alias("byte_change"),
        F.coalesce("change.comment", F.lit("")).alias("comment"),
        "change.server_name",
        F.col("change.type").alias("event_type"),
    )


def _truth(flag: Column) -> Column:
    """Truth of a JSON value: null is false, text is true unless empty, numbers unless 0."""
    kind = F.schema_of_variant(flag)
    text = F.try_variant_get(flag, "$", "string")
    return (
        F.when(flag.isNull() | (kind == "VOID"), False)
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .otherwise(F.coalesce(F.try_variant_get(flag, "$", "double") != 0, F.lit(True)))
    )


def require_history(records: DataFrame) -> DataFrame:
    """The records, if each required field has a value in some record under some spelling; one aggregate."""
    have = set(records.columns)

    def given(names: tuple[str, ...]) -> Column:
        known = [F.col(n).isNotNull() for n in names if n in have]
        return F.coalesce(F.bool_or(F.greatest(*known) if len(known) > 1 else known[0]), F.lit(False)) if known else F.lit(False)

    found = records.agg(*[given(names).alias(name) for name, names in REQUIRED_HISTORY.items()]).first()
    missing = sorted(name for name in REQUIRED_HISTORY if not found[name])
    if missing:
        raise ValueError(f"Historical data is missing required columns: {missing}")
    return records


def normalize_history(records: DataFrame) -> DataFrame:
    """History records under one set of names.

    An empty title or user, and a zero length or time, fall through to the next
    spelling. When both lengths are known the byte change is their difference,
    even over a given one; unreadable numbers count as 0. A record with only
    ``ts`` or ``time`` takes that time.
    """
    have = set(records.columns)
    missing = [name for name, names in REQUIRED_HISTORY.items() if not have.intersection(names)]
    if missing:
        raise ValueError(f"Historical data is missing required columns: {sorted(missing)}")
    types = dict(records.dtypes)

    def column(name: str, kind: str) -> Column:
        return F.col(name).try_cast(kind) if name in have else F.lit(None).cast(kind)

    def falling(kind: str, empty, *names: str) -> Column:
        first = [F.nullif(column(name, kind), F.lit(empty).cast(kind)) for name in names[:-1]]
        return F.coalesce(*first, column(names[-1], kind))

    def flag(name: str) -> Column:
        if name not in have:
            return F.lit(False)
        if types[name] == "variant":
            return _truth(F.col(name))
        if types[name] == "string":
            return F.coalesce(F.col(name) != "", F.lit(False))
        return F.coalesce(F.col(name).cast("boolean"), F.lit(False))

    old = falling("double", 0, "old_length", "oldlen")
    new = falling("double", 0, "new_length", "newlen")
    title = F.coalesce(falling("string", "", "page_title", "title", "page"), column("page_title", "string"))
    user = F.coalesce(falling("string", "", "user", "user_name"), column("user", "string"))
    return records.select(
        title.alias("page_title"),
        user.alias("user"),
        flag("bot").alias("bot"),
        flag("minor").alias("minor"),
        F.coalesce(new - old, column("byte_change", "double"), F.lit(0.0)).alias("byte_change"),
        F.floor(F.coalesce(falling("double", 0, "timestamp", "ts", "time"), F.lit(0.0)))
        .cast("long").alias("timestamp"),
    )


def normalize_api_changes(changes: DataFrame, limit: int | None = None) -> DataFrame:
    """API change records as history records; those without title or user are dropped."""
    rows = changes.limit(limit) if limit is not None else changes
    return rows.filter("title <> '' AND user <> ''").select(
        F.col("title").alias("page_title"),
        "user",
        F.coalesce("bot", F.lit(False)).alias("bot"),
        F.coalesce("minor", F.lit(False)).alias("minor"),
        iso_to_epoch(F.col("timestamp")).alias("timestamp"),
        F.coalesce(F.col("newlen") - F.col("oldlen"), F.lit(0)).cast("long").alias("byte_change"),
    )


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", F.timestamp_seconds("timestamp"))
