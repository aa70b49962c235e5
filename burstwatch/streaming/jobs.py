"""The streaming jobs: scoring edits, ingesting and indexing news, judging anomalies.

Every job writes a batch to its own sub-folder with overwrite (or hands it to a
writer with its id), so a batch that runs again after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from burstwatch.operators import detect, features, news as news_ops, verify
from burstwatch.operators.nearest import RETENTION
from burstwatch.operators.ranking import first_per_key
from burstwatch.schemas import NEWS_SCHEMA
from burstwatch.sources.files import MINUTE_NAME, decode_ngrams, decode_toc, minute_lines
from burstwatch.sources.sinks import keyed_json, trigger
from burstwatch.streaming.state import RECENT_IDS, RecentIds, first_comments, settled_minutes

Writer = Callable[[DataFrame, int], None]
Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def folder_writer(path: str) -> Writer:
    """Batches as Parquet below ``path``, one sub-folder each."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def topic_batch_writer(topic: str, servers: str) -> Writer:
    """Batches of ``key, value`` rows to a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


class Scorer(Protocol):
    """What adds an ``anomaly_score`` to feature rows: a fitted forest, or anything of its shape."""

    def score(self, rows: DataFrame) -> DataFrame: ...


def score_edits(
    events: DataFrame,
    model: Scorer,
    write: Writer,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Score sliding windows as they change and publish the alerts, keyed by page.

    Two states run side by side in one query and see the same edits: the windows' counters
    with a sketch of their editors, and the windows' first comments. Both have a fixed size
    per window. A batch holds a row of either for each window that an edit came into, so that an
    alert carries the comments that belong to its counts; no other table is read. A window that changes
    is published again.
    """
    keys = ["page_title", "window_end"]
    rows = features.sliding(events).withColumn("window_end", F.unix_micros("window.end"))
    both = rows.unionByName(first_comments(events), allowMissingColumns=True)

    def publish(batch: DataFrame, batch_id: int) -> None:
        # one pass over the states serves both halves
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = model.score(batch.filter("window IS NOT NULL").drop("comments")).filter("anomaly_score < 0")
            said = batch.filter("window IS NULL AND comments <> ''").select(
                F.col("page_title").alias("of"), F.col("window_end").alias("until"), F.col("comments").alias("recent_comments")
            )
            same = F.col("page_title").eqNullSafe(F.col("of")) & (F.col("window_end") == F.col("until"))
            alerts = detect.alerts(found.join(said, same, "left").drop("of", "until"))
            write(keyed_json(alerts, "page_title"), batch_id)
        finally:
            batch.unpersist()

    return (
        both.writeStream.foreachBatch(publish).outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


# The kind of a file, the last in its path.
KIND_NAME = r"^.*[/.](toc|ngrams)[/.]"


def landed_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of ``toc_timestamp, kind, path`` of the feed's files below ``path``; their content is not read.

    Files are named ``{minute}.toc.json.gz`` and ``{minute}.ngrams.txt.gz``, or lie in folders
    such as ``toc/{minute}/`` and ``ngrams/{minute}/``.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    minute, kind = F.regexp_extract("path", MINUTE_NAME, 1), F.regexp_extract("path", KIND_NAME, 1)
    named = reader.load(path).select(minute.alias("toc_timestamp"), kind.alias("kind"), "path")
    return named.filter("toc_timestamp <> '' AND kind <> ''")


# In how many tasks Spark lists folders at most.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def with_few_listing_tasks(spark: SparkSession) -> None:
    """List folders in a few tasks per core, where Spark takes one per folder up to thousands.

    Minutes lie in folders of their own: every trigger lists them all, and each batch its own ones
    for reading. The setting stays in the caller's session, in which the source lists.
    """
    few = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING_TASKS, str(min(int(spark.conf.get(LISTING_TASKS)), few)))


def ingest_news(
    spark: SparkSession,
    path: str,
    write: Writer,
    checkpoint: str,
    languages: Sequence[str] = ("en",),
    every: str | None = None,
    files_per_batch: int | None = None,
    hold: timedelta = timedelta(minutes=news_ops.DELAY_MINUTES),
    give_up: timedelta = timedelta(minutes=news_ops.LOOKBACK_MINUTES),
    remember: timedelta = timedelta(minutes=news_ops.LEDGER_MINUTES),
    recent_ids: int = RECENT_IDS,
    keep_ids: timedelta | None = None,
    state_partitions: int = 8,
) -> StreamingQuery:
    """Turn newly landed minute files into article events keyed by ``event_id``.

    A minute is held for ``hold`` after its table of contents came in; while its quadgrams are
    not there it waits on, up to ``give_up``, and is then published without snippets. Without an
    interval (``every``) the files that are there are drained at once, and no minute is held.
    Below the checkpoint, ``ledger`` pairs each published minute with its files, and ``recent`` holds
    the last ``recent_ids`` article ids (of the last ``keep_ids`` only, if given), which are not published again.
    A job that was started again looks at held minutes once the next file has landed.
    """
    with_few_listing_tasks(spark)
    none = timedelta(0)
    minutes = settled_minutes(
        landed_files(spark, path, files_per_batch if every else None),
        *((hold, give_up) if every else (none, none)), remember,
    )
    root = checkpoint.rstrip("/")
    recent = RecentIds(spark, f"{root}/recent", recent_ids, keep=keep_ids)

    def publish(batch: DataFrame, batch_id: int) -> None:
        settled = batch.collect()  # file names of the minutes that were let go
        if not settled:
            return
        toc, ngrams = (sorted(p for r in settled for p in r[kind]) for kind in ("toc", "ngrams"))
        articles = news_ops.assemble(decode_toc(minute_lines(spark, toc)), decode_ngrams(minute_lines(spark, ngrams)), languages)
        recent.publish(articles, batch_id, lambda rows, _: write(keyed_json(rows, "event_id", ignore_nulls=False), batch_id))
        done = spark.createDataFrame(settled, batch.schema).withColumn("settled_at", F.current_timestamp())
        done.coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/batch={batch_id}")

    settings = {
        # batches without files serve the timers; draining would go on with them for ever
        "spark.sql.streaming.noDataMicroBatches.enabled": str(every is not None).lower(),
        # the state is file names only; articles are worked on in the caller's session, with its partitions
        "spark.sql.shuffle.partitions": str(state_partitions),
    }
    with _set_for_start(spark, settings):
        return (
            minutes.writeStream.foreachBatch(publish)
            .option("checkpointLocation", f"{root}/query")
            .trigger(**trigger(every))
            .start()
        )


@contextmanager
def _set_for_start(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """A query keeps the settings it is started with; the session gets its own back."""
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_news_ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``toc_timestamp, toc, ngrams, held_ms, settled_at``: the published minutes with their files."""
    schema = "toc_timestamp string, toc array<string>, ngrams array<string>, held_ms bigint, settled_at timestamp"
    return spark.read.schema(schema).parquet(f"{checkpoint.rstrip('/')}/ledger")


def index_news(
    articles: DataFrame,
    path: str,
    checkpoint: str,
    embedder: verify.Embedder | None = None,
    clock: Clock = utc_now,
    every: str | None = None,
) -> StreamingQuery:
    """Append embedded articles to the news index.

    The index is a log laid out by the hour of ``added_at``: a re-sent article is
    one more row that hides the earlier one on reading, and hours out of reach
    are neither listed nor read. No batch rewrites what is already there. An
    article without id gets a key of its own, so it hides nothing.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        own_key = F.concat_ws(" ", F.lit(f"batch {batch_id} row"), F.monotonically_increasing_id())
        rows = verify.embed_articles(
            batch.withColumn("article_key", F.coalesce("event_id", own_key)), embedder
        ).withColumns({"added_at": F.lit(now).cast("timestamp"), "batch": F.lit(batch_id)})
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/hour={_hour(now)}/part={batch_id}")

    return (
        articles.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def _hour(instant: datetime) -> str:
    return instant.astimezone(timezone.utc).strftime("%Y%m%d%H")


def read_news_index(
    spark: SparkSession, path: str, now: datetime, retention: timedelta = RETENTION
) -> DataFrame:
    """Live articles at ``now``: the latest row per article among the hours in reach."""
    start = now - retention
    hours = int(retention / timedelta(hours=1)) + 2
    names = sorted({_hour(min(start + timedelta(hours=h), now)) for h in range(hours)})
    schema = f"{NEWS_SCHEMA}, article_key string, embedding array<float>, added_at timestamp, batch long"
    try:
        rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/hour={{{','.join(names)}}}/part=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)  # nothing was indexed within reach
    live = rows.filter(F.col("added_at").between(F.lit(start), F.lit(now)))
    return first_per_key(live, ["article_key"], [F.desc("added_at"), F.desc("batch")])


def verify_anomalies(
    anomalies: DataFrame,
    news: Callable[[datetime], DataFrame],
    write: Writer,
    checkpoint: str,
    embedder: verify.Embedder | None = None,
    threshold: float = verify.THRESHOLD,
    retention: timedelta = RETENTION,
    clock: Clock = utc_now,
    every: str | None = None,
) -> StreamingQuery:
    """Judge each emitted anomaly against the articles indexed so far; publish every verdict."""

    def judge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        now = clock()
        rows = verify.embed_anomalies(batch, embedder).withColumn("handled_at", F.lit(now).cast("timestamp"))
        # Kept for this batch only; a checkpoint per batch would pile up.
        inputs = [df.persist(StorageLevel.MEMORY_AND_DISK) for df in (rows, news(now))]
        try:
            judged = verify.verdicts(
                *inputs, threshold, retention, evaluated_at=now, key="article_key", materialize=False
            )
            write(keyed_json(judged, "page_title", ignore_nulls=False), batch_id)
        finally:
            for df in inputs:
                df.unpersist()

    return (
        anomalies.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )
