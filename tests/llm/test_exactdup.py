"""Groups of equal texts against plain grouping."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from burstwatch.llm import exactdup

PREFIX = "p" * exactdup.PREFIX


def some_rows(n=400):
    rng = random.Random(4)
    pool = ["", None, "a", "b", "aé", PREFIX + "x", PREFIX + "y", PREFIX, "z" * 300_000, "z" * 299_999 + "y"]
    rows = [(i, rng.choice(pool) if rng.random() < 0.7 else f"own text {i}") for i in range(n)]
    return rows + [(None, "a"), (None, "a"), (None, "alone"), (7, "seven"), (7, "seven"), (3, "seven")]


def groups(rows):
    found = defaultdict(list)
    for key, text in rows:
        found[text or ""].append(key)
    return found


def largest(ids):
    known = [i for i in ids if i is not None]
    return max(known) if known else None


def test_classes_are_those_of_plain_grouping(docs):
    rows = some_rows()
    own = groups(rows)
    got = exactdup.classes(docs(rows, extra="key").withColumn("full", F.col("text")), columns=["full", "key"]).collect()
    assert len(got) == len(rows)
    kept = defaultdict(list)
    for r in got:
        ids = own[r["full"] or ""]
        assert r["group_size"] == len(ids) and r["keep_id"] == largest(ids) and r["key"] == "x"
        if r["kept"]:
            kept[r["full"] or ""].append(r["doc_id"])
    assert {t: [largest(ids)] for t, ids in own.items()} == dict(kept)


def test_one_whole_row_of_each_group_stays(docs):
    rows = some_rows()
    own = groups(rows)
    table = docs(rows, extra="text_sha256")
    got = exactdup.drop_copies(table)
    assert got.columns == table.columns
    found = got.collect()
    assert sorted((r["text"] or "", str(r["doc_id"])) for r in found) == sorted((t, str(largest(i))) for t, i in own.items())
    again = exactdup.drop_copies(table.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


@pytest.mark.parametrize("hot", [1, 3, exactdup.HOT])
def test_hot_groups_join_as_others_do(spark, monkeypatch, hot):
    monkeypatch.setattr(exactdup, "HOT", hot)
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(9)] + [("c", 0)], "k string, i int")
    sizes = spark.createDataFrame([("a", 50), ("b", 9)], "k string, n long")
    got = exactdup.with_groups(rows, sizes, "k", "n", 60).collect()
    assert sorted((r["k"], r["i"], r["n"]) for r in got) == sorted(
        [("a", i, 50) for i in range(50)] + [("b", i, 9) for i in range(9)] + [("c", 0, None)])


def test_a_full_table_of_bits_only_lets_more_texts_through(docs, monkeypatch):
    monkeypatch.setattr(exactdup, "BITS", 6)
    rows = [(i, f"text {i % 150}") for i in range(300)]
    got = exactdup.classes(docs(rows)).collect()
    assert {r["group_size"] for r in got} == {2} and sum(r["kept"] for r in got) == 150


def test_empty_table(docs):
    assert exactdup.classes(docs([])).collect() == [] == exactdup.drop_copies(docs([])).collect()
