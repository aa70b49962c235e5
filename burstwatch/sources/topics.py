"""Topic sources. The Kafka connector is supplied by the cluster's packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Default names.
EDITS_TOPIC = "wikipedia-edits"
ANOMALIES_TOPIC = "wikipedia-anomalies"
VERDICTS_TOPIC = "anomaly-news-verdicts"
NEWS_TOPIC = "news-topic"
DEFAULT_SERVERS = "localhost:9092"

# How each consumer of the edit topic starts and what it does about lost offsets.
_PURPOSES = {
    "archive": {"startingOffsets": "latest", "failOnDataLoss": "false"},
    "scoring": {"startingOffsets": "latest", "failOnDataLoss": "false"},
    "backfill": {"startingOffsets": "earliest"},
}


def stream_options(
    purpose: str,
    servers: str = DEFAULT_SERVERS,
    topic: str = EDITS_TOPIC,
    group_id: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Source options for ``archive``, ``scoring`` or ``backfill`` reading."""
    if purpose not in _PURPOSES:
        raise ValueError(f"purpose must be one of {sorted(_PURPOSES)}, not {purpose!r}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **_PURPOSES[purpose]}
    if group_id:
        options["kafka.group.id"] = group_id
    return {**options, **extra}


def edit_stream(spark: SparkSession, purpose: str = "scoring", **options: str) -> DataFrame:
    """The edit topic as a stream of ``key, value, partition, offset, timestamp``."""
    return spark.readStream.format("kafka").options(**stream_options(purpose, **options)).load()


def text_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same records from landed files, one JSON text per line in ``value``."""
    return spark.readStream.options(**options).text(path)


def read_topic(spark: SparkSession, topic: str, servers: str = DEFAULT_SERVERS) -> DataFrame:
    """A whole topic as a batch, for the reports."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    return spark.read.format("kafka").options(**options).load()
