"""JSON decoding of topic and file records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from burstwatch.schemas import EDIT_SCHEMA


def decode_edits(
    raw: DataFrame, schema: StructType = EDIT_SCHEMA, metadata: bool = False
) -> DataFrame:
    """Edit records out of ``value``; unreadable ones and those without id are dropped.

    ``metadata`` keeps the transport's ``partition``, ``offset`` and timestamp
    (as ``kafka_timestamp``).
    """
    transport = (
        [F.col("partition"), F.col("offset"), F.col("timestamp").alias("kafka_timestamp")]
        if metadata
        else []
    )
    event = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(once(event), *transport).filter(F.col("event_id").isNotNull())


def once(record: Column) -> Column:
    """The fields of a struct as columns, worked out a single time per row.

    A filter on a parsed field would otherwise be pushed below the projection
    together with a copy of the parse; it cannot pass a generator.
    """
    return F.inline(F.array(record))


def is_object(text: Column) -> Column:
    """True for a JSON object; bad JSON, arrays and scalars give false."""
    return F.json_object_keys(text).isNotNull()


def has_keys(text: Column, keys: Sequence[str]) -> Column:
    """True for an object that carries every key, whatever its value (null included)."""
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.size(F.array_except(wanted, F.json_object_keys(text))) == 0


def decode_json(
    raw: DataFrame,
    schema: StructType | str,
    keep: Sequence[str] = (),
    value: str = "value",
    require: Sequence[str] = (),
) -> DataFrame:
    """Records of JSON objects; every other payload is dropped.

    ``require`` names keys an object must carry; ``keep`` passes columns on.
    """
    text = F.col(value).cast("string")
    return (
        raw.filter(has_keys(text, require) if require else is_object(text))
        .select(F.from_json(text, schema).alias("record"), *keep)
        .select("record.*", *keep)
    )


def require_keys(raw: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return raw.filter(has_keys(F.col(value).cast("string"), keys))
