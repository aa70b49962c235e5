"""Faults and cheapest edits against a search over all edits."""

import random
import re
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from burstwatch.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, mark string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(signature):
    """The least (cost, audit) and its role initials, trying every edit and up to four insertions at each place."""

    @lru_cache(None)
    def go(i, last, room):
        found = []
        if i == len(signature):
            found += [(0, "", "")] * (last in ("", "a"))
        else:
            letter = signature[i]
            steps = [("D", 3, last, "")]
            if letter != "x":
                cut = int(letter.isupper())
                steps += [("K", cut, NEXT.get((last, letter.lower())), letter.lower())]
                steps += [("R", 2 + cut, NEXT.get((last, r)), r) for r in "ua"]
            for edit, cost, to, made in steps:
                rest = go(i + 1, to, 4) if to is not None else None
                if rest:
                    found.append((cost + rest[0], edit + rest[1], made + rest[2]))
        for made in "ua" if room else "":
            to = NEXT.get((last, made))
            rest = go(i, to, room - 1) if to is not None else None
            if rest:
                found.append((2 + rest[0], "I" + rest[1], made + rest[2]))
        return min(found) if found else None

    return go(0, "", 4)


def test_every_signature():
    rng = random.Random(3)
    signatures = {"".join(rng.choice("suaoSUAOxuaua") for _ in range(rng.randint(0, 12))) for _ in range(3000)}
    signatures = sorted(signatures | {""}, key=lambda s: s[::-1])
    rows = [pa.array(signatures, pa.string()), pa.array([s[::-1] for s in signatures], pa.string()), pa.array([1] * len(signatures))]
    batch = pa.RecordBatch.from_arrays(rows, names=["signature", "ending", "conversations"])
    cuts = [batch.slice(i, 500) for i in range(0, len(signatures), 500)]
    got = pa.Table.from_batches(list(repair._solve(iter(cuts)))).to_pylist()
    assert [(r["signature"], r["cost"], r["audit"]) for r in got] == [(s, *cheapest(s)[:2]) for s in signatures]
    assert repair._shared.cache_info().currsize < 200  # endings are merged into few nodes


def test_long_signatures_need_one_entry_a_row():
    long = "ua" * 100_000
    batch = pa.RecordBatch.from_arrays([pa.array([long]), pa.array([long[::-1]]), pa.array([1])], names=["signature", "ending", "n"])
    assert next(repair._solve(iter([batch]))).to_pylist()[0]["audit"] == "K" * len(long)


def brute(rows):
    """Verdict and repaired rows of one conversation; rows are (turn, role, text)."""
    import hashlib

    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    seen, signature, counts = set(), "", [0, 0, 0]
    for _, role, text in rows:
        whole = re.sub(r"[ \t-\r]+\Z", "", text)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        fault = 0 if not whole else 1 if (role, text) in seen else 2 if whole[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        signature += "x" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, initials = cheapest(signature)
    left, made, out = iter(rows), iter(initials), []
    for edit in audit:
        if edit == "I":
            out.append(({"u": "user", "a": "assistant"}[next(made)], ""))
            continue
        _, role, text = next(left)
        if edit != "D":
            initial = next(made)
            out.append((role if edit == "K" else {"u": "user", "a": "assistant"}[initial], text))
    return (gaps, *counts, illegal, cost, audit), out


def some_rows():
    rng = random.Random(6)
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "admin", "", None, "User"])
    text = lambda: rng.choice(["Yes.", "No!", "cut off", "", " \n", None, "é?", "Well. \t", "end…", "x" * 5000 + ".", "a:b\nc."])
    turn = lambda: rng.choice([None, 0, 1, 2, 3, 5, 9, -4])
    rows = [(c, turn(), role(), text(), "m") for c in [None, *range(120)] for _ in range(rng.randint(1, 9))]
    rows += [(500, i, "user" if i % 2 == 0 else "assistant", f"line {i}.", "m") for i in range(250)]
    return rows + [(600, 1, "user", "same.", "m")] * 20


@pytest.mark.parametrize("hot", [2, 4096])
def test_verdicts_and_rows(spark, monkeypatch, hot):
    monkeypatch.setattr("burstwatch.llm.exactdup.HOT", hot)
    rows = some_rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = repair.verdicts(table).cache()
    got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    lines = {}
    fixed = repair.repaired(table, found)
    for r in fixed.collect():
        assert r["turn"] == len(lines.setdefault(r["conv_id"], []))
        lines[r["conv_id"]].append((r["role"], r["text"]))
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(fixed).collect()}
    key = lambda r: -1 if r[0] is None else r[0]
    want = {k if k >= 0 else None: brute([r[1:4] for r in g]) for k, g in groupby(sorted(rows, key=key), key)}
    assert got == {k: v[0] for k, v in want.items()}
    assert lines == {k: v[1] for k, v in want.items() if v[1]}
    import hashlib

    whole = lambda made: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    assert hashes == {k: whole(v[1]) for k, v in want.items() if v[1]}
    for _, made in want.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in made))


def test_absent_rows_only_name_their_conversation(spark):
    table = spark.createDataFrame([(1, 0, "user", "Hi.", "gone"), (2, 0, "user", "Hi.", "gone"), (2, 4, "user", "Hi.", "m")], SCHEMA)
    absent = F.col("mark") == "gone"
    found = repair.verdicts(table, absent=absent)
    assert sorted(map(tuple, found.collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 2, "KI")]
    assert [tuple(r) for r in repair.repaired(table, found, absent=absent).collect()] == [
        (2, 0, "user", "Hi.", "K"), (2, 1, "assistant", "", "I")]


def test_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    found = repair.verdicts(table)
    assert found.collect() == [] == repair.digests(repair.repaired(table, found)).collect()
