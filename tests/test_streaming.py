import gzip
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
import pytest

from burstwatch import detect, edits, features, sinks, sources
from burstwatch.schemas import ANOMALY_SCHEMA, NEWS_SCHEMA, VERDICT_SCHEMA
from burstwatch.streaming import (
    RecentIds, index_news, ingest_news, read_news_index, read_news_ledger, score_edits, verify_anomalies,
)
from burstwatch.streaming.jobs import LISTING_TASKS, folder_writer

NOW = datetime(2026, 8, 10, 14, 0, tzinfo=timezone.utc)


def edit(i, t, page="P", comment="big fire"):
    return {"event_id": f"e{i}", "timestamp": t, "page_title": page, "user": f"u{i}", "bot": False, "minor": False,
            "byte_change": 100, "comment": comment}


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def events(spark, folder):
    return edits.with_event_time(sources.decode_edits(sources.text_stream(spark, str(folder), maxFilesPerTrigger="1")))


def archive(spark, tmp_path):
    stream = sources.decode_edits(sources.text_stream(spark, str(tmp_path / "in")))
    sinks.archive_edits(stream, str(tmp_path / "lake"), str(tmp_path / "cp"), every=None).awaitTermination()
    return sources.read_edit_lake(spark, str(tmp_path / "lake"))


def test_archive_resumes_without_duplicates(spark, tmp_path):
    land(tmp_path / "in", "a.json", [edit(1, 10), "{bad", {"page_title": "no id"}])
    assert archive(spark, tmp_path).count() == 1
    land(tmp_path / "in", "b.json", [edit(2, 20)])
    assert sorted(r["event_id"] for r in archive(spark, tmp_path).collect()) == ["e1", "e2"]
    assert archive(spark, tmp_path).count() == 2


def test_archive_by_day(spark, tmp_path):
    land(tmp_path / "in", "a.json", [edit(1, 10), edit(2, 86410)])
    stream = sources.decode_edits(sources.text_stream(spark, str(tmp_path / "in")))
    sinks.archive_edits(stream, str(tmp_path / "lake"), str(tmp_path / "cp"), every=None, by_day=True).awaitTermination()
    lake = sources.read_edit_lake(spark, str(tmp_path / "lake"))
    assert [r["event_id"] for r in lake.filter("day = '1970-01-02'").collect()] == ["e2"]


def test_feature_lake_backfill(spark, tmp_path):
    land(tmp_path / "in", "a.json", [edit(1, 10), edit(2, 20), edit(3, 20, "Q")])
    for _ in range(2):  # the second run finds nothing new and writes nothing
        stream = sources.decode_edits(sources.text_stream(spark, str(tmp_path / "in")))
        sinks.append_features(stream, str(tmp_path / "lake"), str(tmp_path / "cp")).awaitTermination()
    rows = sources.read_feature_lake(spark, str(tmp_path / "lake")).collect()
    assert sorted((r["page_title"], r["edit_count"]) for r in rows) == [("P", 2), ("Q", 1)]


def test_streams_count_editors_approximately_only(spark, tmp_path):
    land(tmp_path / "in", "a.json", [edit(1, 10)])
    with pytest.raises(ValueError, match="approx"):
        features.sliding(events(spark, tmp_path / "in"), distinct="exact")


def run_windows(spark, tmp_path):
    rows = features.sliding(events(spark, tmp_path / "in"))
    (rows.writeStream.foreachBatch(folder_writer(str(tmp_path / "out"))).outputMode("update")
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(str(tmp_path / "out"))


def test_windows_update_and_late_edits_are_dropped(spark, tmp_path):
    base = 1_800_000_000 // 900 * 900
    land(tmp_path / "in", "a.json", [edit(1, base + 60)])
    run_windows(spark, tmp_path)
    land(tmp_path / "in", "b.json", [edit(2, base + 120)])
    run_windows(spark, tmp_path)
    land(tmp_path / "in", "c.json", [edit(3, base + 7200)])  # moves the watermark past the first windows
    run_windows(spark, tmp_path)
    land(tmp_path / "in", "d.json", [edit(4, base + 180)])  # too late
    out = run_windows(spark, tmp_path)
    first = out.filter(F.col("window.start") == F.timestamp_seconds(F.lit(base)))
    assert sorted(r["edit_count"] for r in first.collect()) == [1, 2]


def test_scoring_job(spark, tmp_path):
    spread = [F.ceil(F.exp(F.randn(seed=i))).alias(c) for i, c in enumerate(("edit_count", "unique_editors", "total_byte_changes"))]
    calm = spark.range(2000).select(
        F.concat(F.lit("p"), "id").alias("page_title"), *spread,
        F.rand(seed=2).alias("bot_ratio"), F.rand(seed=3).alias("minor_edit_ratio"))
    model = detect.IsolationForest.fit(features.with_ratios(calm), trees=30)
    base = 1_800_000_000 // 900 * 900
    land(tmp_path / "in", "a.json", [edit(i, base + i, "Breaking", "[[Fire]] reported") for i in range(300)])
    job = score_edits(events(spark, tmp_path / "in"), model, folder_writer(str(tmp_path / "out")), str(tmp_path / "cp"))
    job.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    alerts = sources.decode_json(out, ANOMALY_SCHEMA).collect()
    assert {r["page_title"] for r in alerts} == {"Breaking"} == {r["key"] for r in out.collect()}
    assert {r["recent_comments"] for r in alerts} == {" | ".join(["Fire reported"] * 5)}
    assert {r["edit_count"] for r in alerts} == {300} and all(r["anomaly_score"] < 0 for r in alerts)
    assert all(r["window_start"].endswith("Z") and r["last_edit_time"].endswith("Z") for r in alerts)


def land_minute(folder, minute, entries, ngrams=None):
    folder.mkdir(exist_ok=True)
    (folder / f"{minute}.toc.json.gz").write_bytes(gzip.compress("\n".join(map(json.dumps, entries)).encode()))
    if ngrams is not None:
        (folder / f"{minute}.ngrams.txt.gz").write_bytes(gzip.compress("\n".join(ngrams).encode()))


def entry(i, **over):
    return {"ID": i, "date": "2026-08-06T02:17:00.000Z", "img": "", "lang": "en", "title": f"T{i}", "url": f"https://e.com/{i}", **over}


def published(spark, out):
    rows = spark.read.schema("key string, value string").option("recursiveFileLookup", "true").parquet(out)
    return sorted((r["toc_id"], r["toc_timestamp"], r["snippet"]) for r in sources.decode_json(rows, NEWS_SCHEMA).collect())


def test_news_ingest(spark, tmp_path):
    out = str(tmp_path / "out")

    def run():
        ingest_news(spark, str(tmp_path / "in"), folder_writer(out), str(tmp_path / "cp")).awaitTermination()
        return published(spark, out)

    land_minute(tmp_path / "in", "20260806021700", [entry(1), entry(2, lang="fr"), entry(3, title=""), entry(4, url="https://e.com/1")],
                ["1\tsome real words here.\t3"])
    assert run() == [(1, "20260806021700", "some real words here")]
    land_minute(tmp_path / "in", "20260806021800", [entry(1), entry(5)])  # no quadgrams; the first URL again
    assert run() == [(1, "20260806021700", "some real words here"), (5, "20260806021800", "")]
    ledger = {r["toc_timestamp"]: (len(r["toc"]), len(r["ngrams"])) for r in read_news_ledger(spark, str(tmp_path / "cp")).collect()}
    assert ledger == {"20260806021700": (1, 1), "20260806021800": (1, 0)}
    # quadgrams of a published minute publish nothing again
    land_minute(tmp_path / "in", "20260806021900", [entry(6)])
    (tmp_path / "in" / "20260806021800.ngrams.txt.gz").write_bytes(gzip.compress(b"5\tfour words too late\t1"))
    assert run()[1:] == [(5, "20260806021800", ""), (6, "20260806021900", "")]


def test_many_minute_folders_are_listed_in_few_tasks(spark, tmp_path):
    minutes = [f"202608060{h}{m:02}00" for h in (2, 3) for m in range(25)]
    for i, minute in enumerate(minutes):
        (tmp_path / "in" / "toc" / f"toc_timestamp={minute}").mkdir(parents=True)
        (tmp_path / "in" / "toc" / f"toc_timestamp={minute}" / "part.txt.gz").write_bytes(gzip.compress(json.dumps(entry(i)).encode()))
    tracker, tasks = spark.sparkContext.statusTracker(), []
    seen = set(tracker.getJobIdsForGroup(None))
    before = spark.conf.get(LISTING_TASKS)
    few = 4 * spark.sparkContext.defaultParallelism
    try:
        ingest_news(spark, str(tmp_path / "in"), folder_writer(str(tmp_path / "out")), str(tmp_path / "cp")).awaitTermination()
        tasks = [
            tracker.getStageInfo(s).numTasks for j in set(tracker.getJobIdsForGroup(None)) - seen
            for s in tracker.getJobInfo(j).stageIds if "load" in tracker.getStageInfo(s).name
        ]
        assert int(spark.conf.get(LISTING_TASKS)) <= few
    finally:
        spark.conf.set(LISTING_TASKS, before)
    assert tasks and max(tasks) <= few
    assert [r[:2] for r in published(spark, str(tmp_path / "out"))] == list(enumerate(minutes))


def test_minutes_wait_for_their_quadgrams(spark, tmp_path):
    import time

    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    land_minute(tmp_path / "in", "20260806021700", [entry(1)])
    job = ingest_news(spark, str(tmp_path / "in"), folder_writer(out), cp, every="1 second",
                      hold=timedelta(seconds=1), give_up=timedelta(hours=1))
    try:
        end = time.monotonic() + 120
        while len([p for p in job.recentProgress if p["batchId"] >= 2]) < 2 and time.monotonic() < end:
            assert job.exception() is None
            time.sleep(0.5)
        assert not (tmp_path / "cp" / "ledger").exists()  # held well past a second
        (tmp_path / "in" / "20260806021700.ngrams.txt.gz").write_bytes(gzip.compress(b"1\there it is now\t1"))
        while not (tmp_path / "cp" / "ledger").exists() and time.monotonic() < end:
            time.sleep(0.5)
    finally:
        job.stop()
    assert published(spark, out) == [(1, "20260806021700", "here it is now")]


def test_recent_ids(spark, tmp_path):
    clock = [NOW]
    handed = {}
    ids = RecentIds(spark, str(tmp_path / "log"), capacity=3, keep=timedelta(hours=5), clock=lambda: clock[0])

    def send(batch, keys):
        rows = spark.createDataFrame([(k,) for k in keys], "event_id string")
        ids.publish(rows, batch, lambda fresh, i: handed.update({i: sorted((r[0] or "" for r in fresh.collect()))}))
        return handed[batch]

    assert send(0, ["a", "b", None, None]) == ["", "", "a", "b"]
    assert send(1, ["a", "c"]) == ["c"]
    assert send(1, ["a", "c"]) == ["c"]  # the batch runs again after a failure
    assert send(2, ["b", "d"]) == ["d"]  # opens a generation
    assert send(3, ["a", "d", "e", "f"]) == ["e", "f"]
    assert send(4, ["a", "d", "g"]) == ["a", "g"]  # the first generation is forgotten
    assert send(4, ["a", "d", "g"]) == ["a", "g"]
    assert send(5, ["d", "h", "i"]) == ["h", "i"]
    assert len(list((tmp_path / "log").iterdir())) <= 3
    clock[0] = NOW + timedelta(hours=6)
    assert send(6, ["h"]) == ["h"]  # too long ago
    with pytest.raises(ValueError, match="capacity"):
        RecentIds(spark, str(tmp_path / "log"), capacity=0)


def test_comments_are_the_earliest_of_each_window(spark, tmp_path):
    base = 1_800_000_000 // 3600 * 3600

    class All:
        def score(self, rows):
            return rows.withColumn("anomaly_score", F.lit(-0.1))

    def run(name, records):
        land(tmp_path / "in", name, records)
        score_edits(events(spark, tmp_path / "in"), All(), folder_writer(str(tmp_path / "out")), str(tmp_path / "cp")).awaitTermination()
        rows = spark.read.schema("key string, value string, batch int").parquet(str(tmp_path / "out"))
        last = {}
        for r in sorted(sources.decode_json(rows, ANOMALY_SCHEMA, ["batch"]).collect(), key=lambda r: r["batch"]):
            last[r["page_title"], r["window_start"][11:16]] = (r["edit_count"], r["recent_comments"])
        return last

    at = datetime.fromtimestamp(base, timezone.utc).strftime("%H:%M")
    first = run("a.json", [edit(i, base + 60 * i, comment=f"note {i}") for i in range(1, 8)] + [edit(8, base + 30, comment="ce")])
    assert first["P", at] == (8, "note 1 | note 2 | note 3 | note 4 | note 5")
    # an earlier comment that comes later, an edit without one, and another page
    second = run("b.json", [edit(9, base + 10, comment="at first"), edit(10, base + 40, comment=None), edit(11, base + 50, page=None)])
    assert second["P", at] == (10, "at first | note 1 | note 2 | note 3 | note 4")
    assert second[None, at] == (1, "big fire")
    run("c.json", [edit(12, base + 7200)])  # the watermark passes the windows
    third = run("d.json", [edit(13, base + 5, comment="too late")])
    assert third["P", at] == second["P", at] and max(k[1] for k in third) > at


def news_record(key, title):
    return {"event_id": key, "title": title, "url": f"https://e.com/{key}", "language": "en", "snippet": ""}


def test_index_replaces_and_expires(spark, tmp_path):
    index = str(tmp_path / "index")

    def add(name, records, now):
        land(tmp_path / "in", name, records)
        stream = sources.decode_json(sources.text_stream(spark, str(tmp_path / "in")), NEWS_SCHEMA)
        index_news(stream, index, str(tmp_path / "cp"), clock=lambda: now).awaitTermination()

    add("a.json", [news_record("k1", "first title"), news_record("k2", "old story"), news_record(None, "no id"), news_record(None, "no id"),
                   {"event_id": "k3", "title": " "}], NOW)
    assert read_news_index(spark, index, NOW - timedelta(days=2)).count() == 0
    live = read_news_index(spark, index, NOW)
    assert live.count() == 4  # the two without id stay apart, the one without text is not indexed
    add("b.json", [news_record("k1", "second title")], NOW + timedelta(hours=20))
    later = read_news_index(spark, index, NOW + timedelta(hours=20))
    assert [r["title"] for r in later.filter("article_key = 'k1'").collect()] == ["second title"]
    expired = read_news_index(spark, index, NOW + timedelta(hours=30)).collect()
    assert [r["event_id"] for r in expired] == ["k1"]


def test_verification_job(spark, tmp_path):
    index = str(tmp_path / "index")
    land(tmp_path / "news", "a.json", [news_record("k1", "Great harbour fire"), news_record("k2", "Stock markets rally")])
    stream = sources.decode_json(sources.text_stream(spark, str(tmp_path / "news")), NEWS_SCHEMA)
    index_news(stream, index, str(tmp_path / "cp1"), clock=lambda: NOW).awaitTermination()
    land(tmp_path / "anomalies", "a.json", [
        {"page_title": "Great_harbour_fire", "window_start": "s", "anomaly_score": -0.2},
        {"page_title": "Great_harbour_fire", "window_start": "s", "anomaly_score": -0.3},
        {"page_title": "Quiet village", "anomaly_score": -0.1}, {"page_title": None, "anomaly_score": -0.1}])
    later = NOW + timedelta(minutes=5)
    verify_anomalies(
        sources.decode_json(sources.text_stream(spark, str(tmp_path / "anomalies")), ANOMALY_SCHEMA),
        lambda now: read_news_index(spark, index, now), folder_writer(str(tmp_path / "out")), str(tmp_path / "cp2"),
        clock=lambda: later).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    rows = sources.decode_json(out, VERDICT_SCHEMA).collect()
    assert len(rows) == 4 and sorted(r["key"] for r in out.collect()) == ["", "Great_harbour_fire", "Great_harbour_fire", "Quiet village"]
    fires = [r for r in rows if r["page_title"] == "Great_harbour_fire"]
    assert len(fires) == 2 and all(r["matched"] and r["matched_article"]["event_id"] == "k1" for r in fires)
    assert next(r for r in rows if r["page_title"] is None)["similarity_score"] is None
    assert all("matched_article" in json.loads(r["value"]) for r in out.collect())


def test_news_streams_carry_snippets_of_whole_documents(spark, tmp_path):
    """Whole texts and their snippets reach the index of the registered stream queries."""
    from burstwatch.operators import news
    from burstwatch.plans import stream_queries, tables

    folder = "/root/testdata/sf0.001"
    snippets = {r["docid"]: r["snippet"] for r in news.build_snippets(tables.ngrams(spark, folder)).collect()}
    stream = stream_queries._news_stream(spark, folder, news.assemble(tables.toc(spark, folder), tables.ngrams(spark, folder)))
    index_news(stream, str(tmp_path / "index"), str(tmp_path / "cp"), clock=lambda: NOW).awaitTermination()
    rows = read_news_index(spark, str(tmp_path / "index"), NOW).collect()
    assert all(r["snippet"] == snippets.get(r["toc_id"], "") for r in rows)
    assert any("\n" in r["title"] for r in rows) and any(r["snippet"] for r in rows)


def test_stream_verdicts_are_the_batch_verdicts(spark):
    from burstwatch.operators import news, verify
    from burstwatch.plans import stream_queries, tables
    from burstwatch.plans.verify_queries import fitted_embedder

    folder = "/root/testdata/sf0.001"
    assembled = news.assemble(tables.toc(spark, folder), tables.ngrams(spark, folder))
    embedder = fitted_embedder(assembled)
    articles = verify.embed_articles(assembled, embedder)
    pages = features.per_page(tables.edits(spark, folder)).select("page_title", F.col("page_title").alias("recent_comments"))
    asked = verify.embed_anomalies(pages, embedder)
    pairs = asked.select("page_title", F.col("embedding").alias("q")).crossJoin(articles.select("event_id", "embedding"))
    dot = F.aggregate(F.zip_with("q", "embedding", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda t, x: t + x)
    best = {r["page_title"]: r["s"] for r in pairs.groupBy("page_title").agg(F.max(dot).alias("s")).collect()}
    got = stream_queries.stream_verdicts(spark, folder).collect()
    assert {r["page_title"] for r in got} == set(best) and all(r["key"] == r["page_title"] for r in got)
    assert all(abs(r["similarity_score"] - best[r["page_title"]]) < 1e-5 for r in got)
    assert all(r["matched"] == (r["similarity_score"] >= 0.65) and r["event_id"] and r["title"] for r in got)


def test_batches_of_landed_files_fill_the_cluster(spark):
    from burstwatch.plans import stream_queries

    cores = spark.sparkContext.defaultParallelism
    assert stream_queries._files_a_batch(spark, 1) == 4
    assert stream_queries._files_a_batch(spark, 8) == 4  # still two batches
    assert stream_queries._files_a_batch(spark, 1000 * cores) == max(4, 2 * cores)
