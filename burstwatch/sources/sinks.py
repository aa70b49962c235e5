"""Sinks, and the row shapes they expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from burstwatch.operators import features


def keyed_json(rows: DataFrame, key: str, ignore_nulls: bool = True) -> DataFrame:
    """``key, value`` rows for a topic: the whole row as JSON, a null key as "".

    Verdicts publish explicit nulls, so they pass ``ignore_nulls=False``.
    """
    options = {"ignoreNullFields": str(ignore_nulls).lower()}
    return rows.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in rows.columns]), options).alias("value"),
    )


def topic_writer(
    keyed: DataFrame, topic: str, servers: str, checkpoint: str, output_mode: str = "update"
) -> DataStreamWriter:
    """A started-by-caller writer of ``key, value`` rows to a topic."""
    return (
        keyed.writeStream.format("kafka").outputMode(output_mode)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def archive_edits(
    events: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "10 seconds",
    by_day: bool = False,
) -> StreamingQuery:
    """Append decoded edits to the Parquet lake; ``every=None`` drains what is there and stops.

    ``by_day`` partitions the lake by the edit's UTC date, so that readers of a
    span of time open only its days.
    """
    rows = events.withColumn("day", F.to_date(F.timestamp_seconds("timestamp"))) if by_day else events
    writer = (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
    )
    return (writer.partitionBy("day") if by_day else writer).start()


def trigger(every: str | None) -> dict:
    """Run at an interval, or drain what is there and stop."""
    return {"processingTime": every} if every else {"availableNow": True}


def append_features(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Aggregate each micro-batch per page into the feature lake, then stop.

    A batch owns its sub-folder and replaces it, so a batch that is run again
    after a failure does not count twice. Empty batches write nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            rows = features.per_page(batch)
            rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_history(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Normalized history as gzipped JSON lines."""
    records.write.mode(mode).option("compression", "gzip").json(path)
