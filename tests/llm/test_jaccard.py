"""The n-gram Jaccard join against brute force."""

import random
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from burstwatch.llm import jaccard
from burstwatch.llm.components import connected_components


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    """(size, smallest id reachable) by position."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        if doc is not None:
            lowest[root] = min(doc, lowest.get(root, doc))
    return [(doc, len(sets[i]), lowest.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def corpus(seed, families=12, words=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 4, 6, 8, 12, words, 3 * words]))]
        for _ in range(rng.randint(1, 7)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(text))
                text[at : at + 1] = rng.choice([[], [f"n{rng.randrange(99)}"], [text[at], "x"]]) or ["y"]
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_agrees_with_brute_force(docs, seed, width, percent):
    rows = corpus(seed)
    found = jaccard.near_duplicates(docs(rows), width=width, percent=percent)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows, width, percent))


def test_nulls_empty_ties_and_repeats(docs):
    long = " ".join(f"t{i}" for i in range(3000))
    rows = [
        (5, "a b c d e"), (3, "A B C D E"), (3, "A B C D E"), (3, "other words in the same id here"), (None, "a b c d e"),
        (None, "only known without an id"), (9, None), (8, ""), (7, " \t\n"), (6, "one"), (2, "ONE"), (10, long), (11, long + " z"),
    ]
    found = jaccard.near_duplicates(docs(rows), width=4, percent=85).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows, 4, 85), key=key)


def test_empty_table(docs):
    assert jaccard.near_duplicates(docs([])).collect() == []
    assert jaccard.keep_one(docs([])).collect() == []


def test_keep_one(docs):
    same = "one two three four five six seven"
    rows = [(4, same), (2, same), (2, same), (None, same), (1, "quite another text with its own words"), (7, None), (8, "")]
    kept = jaccard.keep_one(docs(rows), width=5, percent=80)
    assert kept.columns == ["doc_id", "text", "size"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(2, same), (1, rows[4][1]), (7, None), (8, "")], key=lambda r: r[0]
    )


def test_a_large_group_of_copies_and_near_copies(docs):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(300)]
    rows += [(1000 + i, " ".join([*base[: i % 60], f"n{i}", *base[i % 60 + 1 :]])) for i in range(200)]
    found = jaccard.near_duplicates(docs(rows)).collect()
    assert {r.component_id for r in found} == {0}


def test_tiles_reach_every_linked_pair():
    """k + 1 + s groups: sets that differ in k places still share a non-empty group."""
    for percent in (60, 80, 85, 95):
        for low, groups, spare in jaccard.bands(percent, 5000):
            assert groups == 1 or groups >= (100 - percent) * 2 * low // (100 + percent) + 1 + spare


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 5), (3, 2)] + [(100 + i, 101 + i) for i in range(40)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10} | {100 + i: 100 for i in range(41)}


def test_long_signatures_bound_the_difference():
    rng = np.random.default_rng(5)
    for size, other, shared in [(1, 1, 0), (600, 700, 500), (2040, 2060, 2000), (5000, 5200, 4700)]:
        one = rng.integers(0, 2**63, size, dtype=np.uint64) << np.uint64(1)
        two = np.concatenate([one[:shared], rng.integers(0, 2**63, other - shared, dtype=np.uint64) << np.uint64(1)])
        a, b = jaccard.long_signature(one), jaccard.long_signature(two)
        assert jaccard.differing_bits(a, b) == jaccard.differing_bits(b, a) <= size + other - 2 * shared
        assert jaccard.differing_bits(a, a) == 0


def test_keep_one_tells_groups_apart_that_share_an_id(docs):
    one, two, three = ("a b c d e f g", "h i j k l m n", "o p q r s t u")
    rows = [(None, one), (None, two), (None, one), (1, two), (5, three), (5, one + " " + two)]
    kept = sorted((str(r["doc_id"]), r["text"]) for r in jaccard.keep_one(docs(rows)).collect())
    assert kept == sorted([("None", one), ("1", two), ("5", three), ("5", one + " " + two)])


def test_shingling_short_texts_takes_little_memory():
    texts = pa.array([" ".join(f"w{i * j % 9973}" for j in range(80)) for i in range(4096)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc", "text"])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in jaccard._sets(5, 1, True)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 4096
    assert peak < 60e6, f"{peak / 1e6:.0f} MB"
