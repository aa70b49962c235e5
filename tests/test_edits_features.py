import json

import pytest
from pyspark.sql import functions as F

from burstwatch import edits, features


def change(**over):
    record = {
        "id": 1, "type": "edit", "namespace": 0, "title": "P", "user": "u", "bot": False, "minor": True,
        "timestamp": 9, "comment": "c", "server_name": "en.wikipedia.org", "meta": {"id": "m"},
        "length": {"old": 10, "new": 25}, "revision": {"new": 4},
    }
    record.update(over)
    return json.dumps({k: v for k, v in record.items() if v != "absent"})


def test_change_feed(lines):
    kept = [
        change(), change(meta={"id": "m2"}, type="new", length=None, comment=None, bot="absent", minor=None),
        change(meta={"id": "m3"}, length={"old": None, "new": 5}, revision=None),
    ]
    dropped = [change(server_name="de.wikipedia.org"), change(type="log"), change(namespace=1),
               change(namespace=None), "{bad", "", None]
    rows = {r["event_id"]: r for r in edits.normalize(edits.in_scope(lines(kept + dropped))).collect()}
    assert set(rows) == {"m", "m2", "m3"}
    assert (rows["m"]["old_length"], rows["m"]["new_length"], rows["m"]["byte_change"]) == (10, 25, 15)
    second = rows["m2"]
    assert (second["byte_change"], second["comment"], second["bot"], second["minor"]) == (0, "", False, None)
    assert (rows["m3"]["byte_change"], rows["m3"]["revision_id"]) == (5, None)


def test_history_aliases(spark, lines):
    from burstwatch import sources

    records = [
        {"page_title": "", "title": "T", "user": "", "user_name": "n", "timestamp": 1},
        {"title": "A", "user": "u", "old_length": 0, "new_length": 50, "timestamp": 2},
        {"title": "B", "user": "u", "old_length": 0, "oldlen": 20, "newlen": 50, "byte_change": 1, "timestamp": 3},
        {"title": "C", "user": "u", "bot": "false", "minor": None, "byte_change": "7", "ts": 4},
        {"title": "D", "user": "u", "bot": 0, "minor": 1, "byte_change": "many", "time": 5},
        {"title": "E", "user": "u", "oldlen": 0, "newlen": 5, "timestamp": 0, "ts": 6},
    ]
    rows = edits.normalize_history(sources.decode_history(lines(map(json.dumps, records)))).collect()
    assert [tuple(r) for r in rows] == [
        ("T", "n", False, False, 0.0, 1), ("A", "u", False, False, 0.0, 2), ("B", "u", False, False, 30.0, 3),
        ("C", "u", True, False, 7.0, 4), ("D", "u", False, True, 0.0, 5), ("E", "u", False, False, 5.0, 6),
    ]


def test_history_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['timestamp', 'user'\]"):
        edits.normalize_history(spark.createDataFrame([("P", 1)], "title string, byte_change int"))


def test_api_changes(spark):
    rows = spark.createDataFrame(
        [("P", "u", None, True, "1970-01-01T00:00:05Z", 10, 4), ("P", "u", True, None, "x", None, 4),
         ("", "u", True, True, "x", 1, 1), ("P", None, True, True, "x", 1, 1)],
        "title string, user string, bot boolean, minor boolean, timestamp string, oldlen long, newlen long")
    done = [tuple(r) for r in edits.normalize_api_changes(rows).collect()]
    assert done == [("P", "u", False, True, 5, -6), ("P", "u", True, False, 0, 0)]
    assert edits.normalize_api_changes(rows, limit=1).count() == 1


def activity(spark, rows):
    data = spark.createDataFrame(rows, "page_title string, user string, timestamp long, byte_change long")
    return edits.with_event_time(data.select(
        "*", F.lit(False).alias("bot"), F.lit(False).alias("minor"), F.monotonically_increasing_id().cast("string").alias("event_id")))


def test_tumbling_windows(spark):
    rows = features.tumbling(activity(spark, [
        ("Delta", "a", 0, 1), ("Delta", "a", 9000, 1), ("Eps", "a", 0, 1), ("Eps", "b", 1, -4), ("Eps", None, 2, 1), (None, "a", 3, 1),
    ])).collect()
    found = sorted((r["page_title"], r["edit_count"], r["unique_editors"], r["total_byte_changes"]) for r in rows)
    assert found == [("Delta", 1, 1, 1), ("Delta", 1, 1, 1), ("Eps", 3, 2, 6)]


def test_each_edit_is_in_three_sliding_windows(spark):
    rows = features.sliding(activity(spark, [("P", "a", 1000, 5)])).collect()
    assert sorted(r["window"]["start"].timestamp() % 3600 for r in rows) == [300, 600, 900]
    assert {r["relative_growth"] for r in rows} == {5.0}


def test_missing_sizes_give_zero_ratios(spark):
    data = activity(spark, [("P", None, 0, None)])
    row = features.per_page(data).first()
    assert (row["total_byte_changes"], row["relative_growth"], row["editor_concentration"]) == (None, 0.0, 0.0)


def test_comment_sample_is_bounded_and_ordered(spark):
    rows = spark.range(50).select(
        F.lit("P").alias("page_title"), F.col("id").cast("string").alias("event_id"),
        F.timestamp_seconds(100 - F.col("id")).alias("event_time"),
        F.when(F.col("id") % 2 == 0, "ce").otherwise(F.concat(F.lit("fire "), "id")).alias("comment"))
    sample = features.comment_sample(rows, ["page_title"]).first()["recent_comments"]
    assert sample == "fire 49 | fire 47 | fire 45 | fire 43 | fire 41"


def test_comments_of_flagged_windows_only(spark):
    events = activity(spark, [("P", "a", 1000, 5), ("Q", "a", 1000, 5)]).withColumn("comment", F.lit("[[Fire]]"))
    flagged = features.sliding(events).filter("page_title = 'P' AND window.start = timestamp_seconds(900)")
    rows = features.attach_comments(flagged, events).collect()
    assert [(r["page_title"], r["recent_comments"]) for r in rows] == [("P", "Fire")]


def test_group_limit_runs_before_the_shuffle(spark):
    from burstwatch.operators.ranking import ranked

    rows = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = ranked(rows.repartition(4), ["k"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_required_fields_are_checked_on_the_data(spark):
    import pytest

    from burstwatch.operators import edits

    records = spark.createDataFrame([("A", None, 1), ("B", None, 2)], "title string, user string, ts long")
    with pytest.raises(ValueError, match="user"):
        edits.require_history(records)
    sizeless = spark.createDataFrame([("A", "u", 1)], "title string, user string, ts long")
    assert edits.normalize_history(edits.require_history(sizeless)).first().byte_change == 0
