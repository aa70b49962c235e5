"""Repair of conversation structure: cheapest edits to ``(s?(ua)+)?``, shared over equal endings.

A conversation's structure is its signature, one letter a row: the role's initial and
whether the row must go or ends cut off. What the rest of a conversation costs depends
only on the rest of its signature and on what the grammar allows next, so equal endings of
all conversations are solved once. Distinct signatures are sorted from their end, which lays
those with a common ending side by side (a trie of reversed signatures, kept as a stack).
Its nodes are minimised on the way: a node is the cost of each grammar state above the
cheapest, the edits that lead on, and the order of the four remaining audits; nodes that
agree in these are one object, and each pair of such a node and a letter is worked out once.
Two audits of one cost first differ where one has another letter, as each has one letter a
row beside its insertions, whose number differs only with the cost; so the order of the
remaining audits is all that comparing longer ones needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.llm.exactdup import with_groups
from burstwatch.llm.shared import SPACES, stored, with_workers

#: What the edits cost, and their letters.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
LETTERS = {"keep": "K", "rerole": "R", "delete": "D", "insert": "I"}
ENDINGS = ".!?"

# Grammar states: nothing yet, after a system, a user, an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = "sua"
#: Where a row with an initial leads from each state.
_NEXT = [
    {"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER},
]
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_MUST_GO = "x"

Value = tuple[int, str, int, int]  # cost, letters up to the next row, state there, order of what follows


@dataclass(frozen=True)
class Node:
    """Of each grammar state: cost above the cheapest, letters, state behind them, and its audit's place among the four."""

    costs: tuple[int, ...]
    letters: tuple[str, ...]
    after: tuple[int, ...]
    order: tuple[int, ...]


def _closed(base: list[Value | None]) -> tuple[int, Node]:
    """The node of the best values before a row, with rows inserted in front of it, and its cheapest cost."""
    best = []
    for state in range(4):
        found, at, letters = [], state, ""
        for _ in range(3):  # a third insertion would come back to a state already met
            if base[at] is not None:
                cost, own, after, order = base[at]
                found.append((cost + INSERT * len(letters), letters + own, after, order))
            at = _ASSISTANT if at == _USER else _USER
            letters += LETTERS["insert"]
        best.append(min(found, key=lambda v: (v[0], v[1], v[3])))
    low = min(v[0] for v in best)
    places = {k: i for i, k in enumerate(sorted({(v[1], v[3]) for v in best}))}
    return low, _shared(Node(
        tuple(v[0] - low for v in best), tuple(v[1] for v in best), tuple(v[2] for v in best),
        tuple(places[v[1], v[3]] for v in best),
    ))


@lru_cache(None)
def _shared(node: Node) -> Node:
    return node


@lru_cache(None)
def _step(letter: str, rest: Node) -> tuple[int, Node]:
    """The node before a row with this letter, and what is added to the cheapest cost. Both are few."""
    base: list[Value | None] = []
    for state in range(4):
        found = [(DELETE + rest.costs[state], LETTERS["delete"], state, rest.order[state])]
        if letter != _MUST_GO:
            cut, initial = CUT_OFF * letter.isupper(), letter.lower()
            kept = _NEXT[state].get(initial)
            changed = _ASSISTANT if state == _USER else _USER
            if kept is not None:
                found.append((KEEP + cut + rest.costs[kept], LETTERS["keep"], kept, rest.order[kept]))
            found.append((REROLE + cut + rest.costs[changed], LETTERS["rerole"], changed, rest.order[changed]))
        base.append(min(found, key=lambda v: (v[0], v[1], v[3])))
    return _closed(base)


@lru_cache(None)
def _end() -> tuple[int, Node]:
    """The node behind the last row: only nothing and an assistant row may end a conversation."""
    return _closed([(0, "", _START, 0), None, None, (0, "", _ASSISTANT, 0)])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of signatures that come sorted by their reversal."""
    stack = [_end()]
    before = ""
    for batch in batches:
        costs, audits = [], []
        for ending in batch.column(1).to_pylist():
            common = _common(before, ending)
            del stack[common + 1 :]
            for letter in ending[common:]:
                added, node = _step(letter, stack[-1][1])
                stack.append((stack[-1][0] + added, node))
            before, state, letters = ending, _START, []
            costs.append(stack[-1][0] + stack[-1][1].costs[_START])
            for _, node in reversed(stack):
                letters.append(node.letters[state])
                state = node.after[state]
            audits.append("".join(letters))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            names=["signature", "conversations", "cost", "audit"],
        )


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by bisection on slices."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def solved(signatures: DataFrame) -> DataFrame:
    """``signature, conversations, cost, audit`` of rows with a ``signature`` and how many ``conversations`` have it.

    Rows are dealt by ranges of the reversed signature, so that one ending is met in one task
    (twice at a border between two).
    """
    rows = with_workers(signatures).select("signature", F.reverse("signature").alias("ending"), "conversations")
    rows = rows.repartitionByRange("ending").sortWithinPartitions("ending")
    return rows.mapInArrow(_solve, "signature string, conversations long, cost long, audit string")


# What a row is, in one number.
_BLANK, _CUT, _LATER, _ABSENT = 4, 8, 16, 32


def _rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, absent: Column | None) -> DataFrame:
    own = {"conv_id": F.col(conv_id), "turn": F.col(turn).cast("long"), "absent": F.lit(False) if absent is None else absent}
    rows = conversations.select(
        *[c.alias(n) for n, c in own.items()],
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def _marked(rows: DataFrame) -> DataFrame:
    """Narrow rows: id, turn, role, digest, what was said as a key, and what the row is."""
    whole = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    code = F.lit(3)
    for i, letter in enumerate(_INITIALS):
        code = F.when(initial == letter, i).otherwise(code)
    key = F.concat(
        F.when(F.col("conv_id").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
        F.lit(":"), F.hex("digest"), F.lit(":"), F.col("role"),
    )
    flags = F.when(whole == "", _BLANK).when(~F.substring(whole, -1, 1).isin(*ENDINGS), _CUT).otherwise(0)
    narrow = stored(rows.select(
        "conv_id", "turn", "role", "digest", F.unhex(F.md5(key)).alias("said"),
        (code + flags + F.when(F.col("absent"), _ABSENT).otherwise(0)).alias("mark"),
    ), "marked")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    present = narrow.where(F.col("mark") < _ABSENT)
    again = stored(
        present.groupBy("said").agg(F.count("*").alias("times"), F.min(at).alias("first")).where("times > 1"), "again"
    )
    found = with_groups(narrow, again, "said", "times", narrow.count())
    later = F.coalesce(at > F.col("first"), F.lit(False)) & (F.col("mark") < _ABSENT)
    return found.select("conv_id", "turn", "role", "digest", "said", (F.col("mark") + F.when(later, _LATER).otherwise(0)).alias("mark"))


class _Open:
    """A conversation whose rows are still coming: its signature, sums, first turn, and its last row."""

    def __init__(self, key):
        self.key, self.signature, self.sums = key, [], np.zeros(5, np.int64)
        self.low = self.high = None
        self.last = None  # turn, what was said, initial

    def add(self, turn: np.ndarray, known: np.ndarray, said: np.ndarray, mark: np.ndarray) -> None:
        """Rows in order, absent ones left out. Sums: blank, duplicate, cut off, illegal pairs, distinct turns."""
        if not len(mark):
            return
        initial = mark & 3
        if self.last is not None:
            turn, known, said, initial = (np.concatenate([[x], y]) for x, y in zip(self.last, (turn, known, said, initial)))
        same_turn = (turn[1:] == turn[:-1]) & (known[1:] == known[:-1])
        again = same_turn & (said[1:] == said[:-1]).all(axis=1)
        pairs = initial[:-1] * 4 + initial[1:]
        # su, ua, au
        illegal = ~np.isin(pairs, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        if self.last is None:
            again, new = np.concatenate([[False], again]), np.concatenate([[known[0]], known[1:] & ~same_turn])
        else:
            new = known[1:] & ~same_turn
        self.last = turn[-1], known[-1], said[-1], initial[-1]
        blank = mark & _BLANK > 0
        double = ~blank & ((mark & _LATER > 0) | again)
        cut = ~blank & ~double & (mark & _CUT > 0)
        self.sums += [blank.sum(), double.sum(), cut.sum(), illegal.sum(), new.sum()]
        letters = np.frombuffer(b"suao", np.uint8)[mark & 3] - np.where(cut, 32, 0)
        self.signature.append(np.where(blank | double, ord(_MUST_GO), letters).astype(np.uint8).tobytes())
        numbers = turn[known]
        if len(numbers):
            self.low, self.high = int(numbers[0]) if self.low is None else self.low, int(numbers[-1])

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - int(self.sums[4])
        return self.key, b"".join(self.signature).decode(), gaps, *self.sums[:4].tolist()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures and counts of conversations whose rows come in order; held is a byte a row of one of them."""
    names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
    held, kind = None, None

    def batch_of(done: list[_Open]) -> pa.RecordBatch:
        columns = list(zip(*(d.row() for d in done)))
        kinds = [kind, pa.string(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        kind = batch.schema.field(0).type
        keys = batch.column(0).to_pylist()
        turn = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
        known = np.asarray(batch.column(1).is_valid())
        said = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(-1, 2)
        mark = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
        here = mark < _ABSENT
        begins = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        done = []
        for a, b in zip([0, *begins], [*begins, len(keys)]):
            if a == b:
                continue
            if held is None or held.key != keys[a]:
                if held is not None:
                    done.append(held)
                held = _Open(keys[a])
            rows = np.flatnonzero(here[a:b]) + a
            held.add(turn[rows], known[rows], said[rows], mark[rows])
        if done:
            yield batch_of(done)
    if held is not None:
        yield batch_of([held])


_ORDER = ["conv_id", "turn", "role", "digest"]


def verdicts(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    absent: Column | None = None,
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``: one row per conversation.

    Rows are taken by ``turn`` (null first), ties by role, then by the md5 of the text. Null roles
    and texts count as one space. A row's first fault counts: blank (white space only), duplicate
    (role and text seen earlier), truncated (its last character is not one of ``.!?``). ``gaps`` is
    how many numbers between the first and the last turn no row has; null turns are left out.
    ``illegal`` counts neighbours whose roles' initials are not su, ua or au. ``audit`` has a
    letter for each edit of the cheapest repair: Keep, Rerole to user or assistant, Delete
    (required for blank and duplicate rows), Insert an empty user or assistant row; of
    several the least in ASCII order. Rows with ``absent`` true only name their conversation,
    which then has zeros and an empty audit if it has no other rows. Rows without id form one
    conversation. Repeated rows are duplicates. Other columns are not read; an empty table gives
    an empty result. Rows stream through a task in order, without their texts; held are one
    conversation's signature and the answers to its endings, as its audit is one value.
    """
    rows = _marked(_rows(with_workers(conversations), conv_id, turn, role, text, absent))
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartition("conv_id").sortWithinPartitions(*_ORDER)
    signed = stored(rows.select("conv_id", "turn", "said", "mark").mapInArrow(
        _signed, f"conv_id {kind}, signature string, gaps long, blank long, duplicate long, truncated long, illegal long"
    ), "signed")
    distinct = stored(signed.groupBy("signature").agg(F.count("*").alias("conversations")), "signatures")
    answers = stored(solved(distinct), "solved")
    return with_groups(signed, answers, "signature", "conversations", signed.count()).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of conversations that come as their audit and then their rows in order."""
    audit, at, state, nth = "", 0, _START, 0
    for batch in batches:
        out: list[tuple] = []

        def inserted(key) -> None:
            nonlocal at, state, nth
            while at < len(audit) and audit[at] == LETTERS["insert"]:
                state = _ASSISTANT if state == _USER else _USER
                out.append((key, nth, _ROLES[state], "", audit[at]))
                at, nth = at + 1, nth + 1

        for key, role, text, edits in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if edits is not None:
                audit, at, state, nth = edits, 0, _START, 0
                inserted(key)
                continue
            edit, at = audit[at], at + 1
            if edit != LETTERS["delete"]:
                if edit == LETTERS["keep"]:
                    state = _NEXT[state][role[:1]]
                else:
                    state = _ASSISTANT if state == _USER else _USER
                    role = _ROLES[state]
                out.append((key, nth, role, text, edit))
                nth += 1
            inserted(key)
        columns = list(zip(*out)) or [()] * 5
        kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["conv_id", "turn", "role", "text", "edit"]
        )


def repaired(
    conversations: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", absent: Column | None = None,
) -> DataFrame:
    """``conv_id, turn, role, text, edit``: the rows after the edits that :func:`verdicts` ``found``, turns from 0.

    ``edit`` is the letter of the edit that made the row. The rows of a conversation come
    together and in order; texts are shuffled once and pass through one by one.
    """
    rows = _rows(with_workers(conversations), conv_id, turn, role, text, absent).where(~F.col("absent")).drop("absent")
    heads = found.select("conv_id", F.col("audit"))
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(heads, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER[1:])
    kind = both.schema["conv_id"].dataType.simpleString()
    return both.select("conv_id", "role", "text", "audit").mapInArrow(
        _edited, f"conv_id {kind}, turn long, role string, text string, edit string"
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest, kind = None, None, None

    def row(pairs: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in pairs], kind), pa.array([d.hexdigest() for _, d in pairs], pa.string())],
            names=["conv_id", "repaired_sha256"],
        )

    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if digest is None or key != current:
                if digest is not None:
                    done.append((current, digest))
                current, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield row(done)
    if digest is not None:
        yield row([(current, digest)])


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the rows of :func:`repaired`, as they come: ``role:text`` lines, hashed one by one."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.select("conv_id", "role", "text").mapInArrow(_hashed, f"conv_id {kind}, repaired_sha256 string")
