"""What the streaming jobs remember between batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from burstwatch.functions.text import clean_comment, has_content
from burstwatch.operators.features import SAMPLE_SEPARATOR, SAMPLE_SIZE, SLIDE, WATERMARK, WINDOW
from burstwatch.sources.decode import once
from burstwatch.streaming import processors
from burstwatch.streaming.processors import FirstComments, Settling

cloudpickle.register_pickle_by_value(processors)

# Stateful processors keep their state in this store only.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Fixed value: how many article ids are remembered.
RECENT_IDS = 20_000


def with_state_store(spark: SparkSession) -> None:
    """Sessions of any origin need the store that the processors below require."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def first_comments(
    events: DataFrame, window: str = WINDOW, slide: str = SLIDE, watermark: str = WATERMARK, n: int = SAMPLE_SIZE,
    span: timedelta = timedelta(hours=1),
) -> DataFrame:
    """``page_title, window_end, comments`` of every window that an edit came into.

    ``window_end`` is in microseconds. A window that is already behind the watermark gets
    no row, as in :func:`burstwatch.operators.features.sliding`: both go by the window's end.
    Comments are cleaned once per edit, before the edit goes to its windows. Windows of a
    page that end within one ``span`` share a state, which is fetched and written once a batch.
    """
    with_state_store(events.sparkSession)
    micros = span // timedelta(microseconds=1)
    cleaned = once(F.struct(clean_comment(F.col("comment")).alias("candidate")))
    rows = events.withWatermark("event_time", watermark).select("page_title", "event_time", "event_id", cleaned)
    rows = rows.withColumn("candidate", F.when(has_content(F.col("candidate")), F.col("candidate")))
    windowed = rows.select(
        F.window("event_time", window, slide).alias("window"), "page_title", "event_id", "candidate",
        F.unix_micros("event_time").alias("at"),
    ).withColumn("window_end", F.unix_micros("window.end"))
    # a window that ends at the border of two spans belongs to the first
    keyed = windowed.withColumn("span", F.floor((F.col("window_end") - 1) / micros).cast("long"))
    return keyed.groupBy("page_title", "span").transformWithState(
        FirstComments(n, micros, SAMPLE_SEPARATOR), "page_title string, window_end bigint, comments string", "Update", "EventTime"
    )


def settled_minutes(
    files: DataFrame, hold: timedelta = timedelta(minutes=5), give_up: timedelta = timedelta(minutes=45),
    remember: timedelta = timedelta(minutes=180),
) -> DataFrame:
    """``toc_timestamp, toc, ngrams, held_ms`` of minutes, once each, from a stream of ``toc_timestamp, kind, path``.

    ``kind`` is toc or ngrams; ``toc`` and ``ngrams`` are the paths of the minute's files. See :class:`Settling`.
    """
    with_state_store(files.sparkSession)
    return files.groupBy("toc_timestamp").transformWithState(
        Settling(hold, give_up, remember),
        "toc_timestamp string, toc array<string>, ngrams array<string>, held_ms bigint", "Append", "ProcessingTime",
    )


class RecentIds:
    """Ids handed on lately, remembered by number on shared storage.

    Ids are logged in generations. A batch that finds its generation with at least ``capacity`` ids
    opens the next one; known are the ids of the last two. So the latest ``capacity`` ids are always known
    and those more than twice as many (and a batch) back never. ``keep`` also forgets what is older than
    that. Generations take three folders in turn, and a new one replaces the third last: neither what is
    stored nor what is listed grows. A batch that runs again sees only what the batches before it logged,
    and replaces its own entry, so it hands on the same rows. Rows without id are always handed on.
    """

    def __init__(
        self, spark: SparkSession, path: str, capacity: int = RECENT_IDS, key: str = "event_id",
        keep: timedelta | None = None, clock: Callable[[], datetime] | None = None,
    ):
        if capacity < 1:
            raise ValueError("capacity must be at least 1")
        self.spark, self.path, self.capacity, self.key, self.keep = spark, path.rstrip("/"), capacity, key, keep
        self.clock = clock or (lambda: datetime.now().astimezone())

    def _log(self, before: int, slots: Sequence[int] = (0, 1, 2)) -> DataFrame:
        """What earlier batches logged; a folder read here is not the one that the batch replaces."""
        schema = "id string, generation bigint, seen_at timestamp, batch bigint"
        try:
            names = ",".join(map(str, slots))
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/slot={{{names}}}/part=*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)
        return rows.filter(F.col("batch") < before)

    def publish(self, rows: DataFrame, batch_id: int, write: Callable[[DataFrame, int], None]) -> None:
        """Hand the rows with an id that is not known to ``write``, and remember their ids.

        Of several rows with one id in the batch all are handed on; drop repeats before.
        """
        sizes = {r["generation"]: r["n"] for r in self._log(batch_id).groupBy("generation").agg(F.count("*").alias("n")).collect()}
        last = max(sizes, default=-1)
        opened = sizes.get(last, self.capacity) >= self.capacity
        current = last + opened
        known = self._log(batch_id, [(current - 1) % 3] if opened else [(current - 1) % 3, current % 3])
        known = known.filter(F.col("generation") >= current - 1)
        now = self.clock()
        if self.keep is not None:
            known = known.filter(F.col("seen_at") > F.lit(now - self.keep))
        known = known.select(F.col("id").alias("known_id")).distinct()
        fresh = rows.join(known, F.col(self.key).cast("string") == F.col("known_id"), "left_anti")
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(fresh, batch_id)
            entry = fresh.filter(F.col(self.key).isNotNull()).select(
                F.col(self.key).cast("string").alias("id"), F.lit(current).cast("bigint").alias("generation"),
                F.lit(now).cast("timestamp").alias("seen_at"), F.lit(batch_id).cast("bigint").alias("batch"),
            ).distinct()
            slot = f"{self.path}/slot={current % 3}"
            if opened:  # what the slot held is three generations old
                entry.withColumn("part", F.col("batch")).write.partitionBy("part").mode("overwrite").parquet(slot)
            else:
                entry.write.mode("overwrite").parquet(f"{slot}/part={batch_id}")
        finally:
            fresh.unpersist()
