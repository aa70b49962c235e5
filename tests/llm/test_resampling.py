"""Checksums against zlib, weights and draw against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from burstwatch.llm import resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def brute(rows, target, longest, buckets, percent, least, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, longest)[1])
    t = Counter(bucket(f) for text in target for f in features(text, longest)[1])
    own, theirs = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (own + buckets) / ((s[b] + 1) * (theirs + buckets)))) for b in s}
    out = []
    for key, text in rows:
        words, found = features(text, longest)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1:4]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


def test_checksums_of_any_length():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    sizes = np.array([1, 2, 63, 64, 65, 127, 128, 129, 4096, 4097, 150_000, *rng.integers(1, 400, 300)])
    starts = np.array([rng.integers(0, len(data) - n + 1) for n in sizes])
    got = resampling.crc32s(data, starts, starts + sizes)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, sizes)]


def some_rows():
    rng = random.Random(5)
    words = ["Tree", "tree", "élan", "x1", "straße", "w" * 70, "v" * 500, "日本", "no."]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(0, 40))) for i in range(200)] + [(200 + i, None) for i in range(3)] + [(210, ""), (211, "...")]
    return rows + [(5, rows[5][1])] * 30 + [(None, text(30))] * 4 + [(None, text(25))] + [(300, "tree " * 60_000)]


@pytest.mark.parametrize("longest, percent, least", [(1, 10, 20), (3, 50, 0), (2, 100, 1)])
def test_draw_is_the_plain_one(spark, docs, longest, percent, least):
    rows, target = some_rows(), ["Tree x1 tree", None, "", "élan straße " * 4]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(
        docs(rows, extra="bucket"), benchmark, longest=longest, buckets=50, percent=percent, min_words=least).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, target, longest, 50, percent, least)


def test_many_copies_of_a_drawn_row_take_successive_ranks(docs, monkeypatch):
    monkeypatch.setattr(resampling, "RUN", 7)
    rows = [(1, "a b c")] * 40 + [(2, "a b")] * 3
    got = resampling.resample(docs(rows), docs([(1, "a")]), percent=60, min_words=1).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 26)) and len(got) == 43


def test_empty_tables(docs):
    assert resampling.resample(docs([]), docs([(1, "a")])).collect() == []
    alone = resampling.resample(docs([(1, "a " * 30)]), docs([]), percent=100).collect()
    assert [r["rank"] for r in alone] == [1]
