import gzip
import json

import pytest
from pyspark.sql import functions as F

from burstwatch import edits, features, sinks, sources
from burstwatch.schemas import EDIT_SCHEMA_NO_COMMENT, VERDICT_SCHEMA


def write_lines(path, records, compress=False):
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n"
    path.write_bytes(gzip.compress(text.encode()) if compress else text.encode())
    return str(path)


def test_stream_options():
    options = sources.stream_options("scoring", "b:1", group_id="g")
    assert options["failOnDataLoss"] == "false" and options["startingOffsets"] == "latest"
    assert options["kafka.group.id"] == "g" and options["subscribe"] == "wikipedia-edits"
    backfill = sources.stream_options("backfill")
    assert backfill["startingOffsets"] == "earliest" and "failOnDataLoss" not in backfill
    with pytest.raises(ValueError):
        sources.stream_options("other")


def test_decode_edits_drops_unreadable(lines):
    raw = lines(['{"event_id": "a", "page_title": "P", "bot": true}', "{bad", "", '{"page_title": "Q"}', "[1]", None])
    rows = sources.decode_edits(raw).collect()
    assert [(r["event_id"], r["page_title"], r["bot"], r["comment"]) for r in rows] == [("a", "P", True, None)]
    assert "comment" not in sources.decode_edits(raw, EDIT_SCHEMA_NO_COMMENT).columns


def test_decode_json_and_required_keys(spark, lines):
    raw = lines(['{"page_title": null, "matched": false}', "[]", "no", '"x"', "7", '{"page_title": "P"}'])
    assert sources.decode_json(raw, "page_title string").count() == 2
    assert sources.require_keys(raw, ["page_title", "matched"]).count() == 1
    bytes_rows = raw.select(F.col("value").cast("binary").alias("value"))
    assert sources.decode_json(bytes_rows, VERDICT_SCHEMA, require=["matched"]).first()["matched"] is False


HISTORY = [
    {"title": "Alpha", "user": "u1", "byte_change": 120, "timestamp": 1},
    {"title": "Alpha", "user": "u2", "bot": True, "minor": True, "byte_change": -80, "timestamp": 2},
    "", "   ", "[1]", "3",
    {"page": "Beta", "user_name": "u3", "byte_change": 300, "timestamp": 3},
]


@pytest.mark.parametrize("compress", [False, True])
def test_history_to_features(spark, tmp_path, compress):
    path = write_lines(tmp_path / ("h.jsonl" + (".gz" if compress else "")), HISTORY, compress)
    records = edits.normalize_history(sources.read_history(spark, path))
    rows = {r["page_title"]: r for r in features.tumbling(edits.with_event_time(records)).collect()}
    assert set(rows) == {"Alpha", "Beta"}
    alpha = rows["Alpha"]
    assert (alpha["edit_count"], alpha["bot_ratio"], alpha["total_byte_changes"]) == (2, 0.5, 200.0)
    assert alpha["unique_editors"] == 2 and alpha["human_bot_friction"] == 0.0


def test_history_names_the_malformed_line(spark, tmp_path):
    path = write_lines(tmp_path / "h.jsonl", [{"title": "A", "user": "u"}, '{"broken'])
    with pytest.raises(Exception, match="Invalid JSON in .*h.jsonl.*broken"):
        sources.read_history(spark, path).collect()
    assert sources.read_history(spark, path, strict=False).count() == 1


def test_history_without_records(spark, tmp_path):
    with pytest.raises(ValueError, match="No records"):
        sources.read_history(spark, write_lines(tmp_path / "h.jsonl", ["", "[1]"]))


def test_history_writer(spark, tmp_path):
    rows = spark.createDataFrame([("P", "u", False, True, 5, 7)], "page_title string, user string, bot boolean, minor boolean, timestamp long, byte_change long")
    sinks.write_history(rows, str(tmp_path / "out"))
    back = edits.normalize_history(sources.read_history(spark, str(tmp_path / "out"))).first()
    assert back.asDict() == {"page_title": "P", "user": "u", "bot": False, "minor": True, "byte_change": 7.0, "timestamp": 5}


def test_feature_lake_reads_nested_files(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a" / "b"))
    spark.range(3).withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "c"))
    lake = sources.read_feature_lake(spark, str(tmp_path))
    assert lake.count() == 5 and lake.filter("extra IS NULL").count() == 2


@pytest.mark.parametrize("name", ["missing", ""])
def test_feature_lake_without_files(spark, tmp_path, name):
    with pytest.raises(FileNotFoundError, match="No feature lake"):
        sources.read_feature_lake(spark, str(tmp_path / name))


def test_edit_lake_passes_over_empty_files(spark, tmp_path):
    spark.createDataFrame([("a", 60, None, None)], "event_id string, timestamp long, bot boolean, byte_change long").write.parquet(str(tmp_path / "lake"))
    (tmp_path / "lake" / "part-9.parquet").touch()
    row = sources.read_edit_lake(spark, str(tmp_path / "lake")).select(
        "event_id", F.unix_seconds("event_time").alias("t"), "bot", "byte_change", "minor").collect()
    assert [tuple(r) for r in row] == [("a", 60, False, 0, False)]


def test_news_files(spark, tmp_path):
    write_lines(tmp_path / "20260806021700.toc.json.gz", [{"ID": 1, "title": "t", "url": "u"}, "", "{bad", "[2]"], True)
    ngrams = ["one-column", "abc\tsome quadgram\t5", "56\tsome quadgram\tnotanumber", "56\t\t3", "56\t  \t3", "56\ta\tb\t3", "56\treal quadgram here\t3"]
    write_lines(tmp_path / "20260806021700.ngrams.txt.gz", ngrams, True)
    write_lines(tmp_path / "20260806021800.ngrams.txt.gz", ["1\tother minute here now\t1"], True)
    toc = sources.read_toc(spark, str(tmp_path)).collect()
    assert [(r["ID"], r["toc_timestamp"]) for r in toc] == [(1, "20260806021700")]
    read = sources.read_ngrams(spark, str(tmp_path), ["20260806021700", "20260806021900"]).collect()
    assert [(r["docid"], r["quadgram"], r["count"]) for r in read] == [(56, "real quadgram here", 3)]


def test_a_line_of_the_news_feed_is_taken_apart_once(lines):
    """Filters on the fields do not repeat what the fields are made by."""
    odd = ["+7\ta b c d\t-2\r\n", "\u20288\x85\t\u3000a b\u2028\t 3\x85", "9\ta\t1.5", "1 2\ta\t3", "9\n9\ta\t3", "\ta\t3", "99999999999999999999\ta\t3"]
    grams = sources.decode_ngrams(lines(odd), keep=())
    assert [tuple(r) for r in grams.collect()] == [(7, "a b c d", -2), (8, "a b", 3)]
    toc = sources.decode_toc(lines(['{"ID": 1, "title": "t", "url": "u"}', "{bad"]), keep=()).filter("title <> '' AND url <> ''")
    assert [(r["ID"], r["title"], r["url"]) for r in toc.collect()] == [(1, "t", "u")]
    for rows, made_by in ((grams, "split("), (toc, "from_json(")):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count(made_by) == 1


def test_keyed_json(spark):
    rows = spark.createDataFrame([(None, 1, None), ("P", 2, "x")], "page_title string, n int, note string")
    plain = [tuple(r) for r in sinks.keyed_json(rows, "page_title").collect()]
    assert plain == [("", '{"n":1}'), ("P", '{"page_title":"P","n":2,"note":"x"}')]
    explicit = sinks.keyed_json(rows, "page_title", ignore_nulls=False).first()
    assert json.loads(explicit["value"]) == {"page_title": None, "n": 1, "note": None}
