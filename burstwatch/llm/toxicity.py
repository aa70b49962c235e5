"""Toxicity: a lexicon found through Levenshtein automata, and windows that weigh each find.

The lexicon is learned: words that occur far more often in toxic than in other labelled
texts, and stems of which toxic texts have two or more words far more often. How many texts
that takes does not depend on how many there are, and no number of terms is too many. The words' trie is
intersected with the Levenshtein automaton of each allowed distance (one edit from five
letters on, two from ten on; in a stem as well, which any ending may follow); the product is made
deterministic once, on the driver, as a table of states that grows with the terms. Tasks run every word of a batch
through the table at the same time, one letter per step, and most words leave it after two
or three letters. Letters are code points of any script in lower case, so an accent or a Cyrillic letter
that is wrong, missing or too much is one edit.

A find counts by its context window: quotation marks on both sides within the window speak
of quotation, other finds nearby of abuse. Counts of exact and of misspelled finds, quoted or
not, their density and the densest window make the features of a logistic regression.
The lexicon and the regression are fitted on at most ``sample`` labelled texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.llm.batches import Chunk, chunks, word_bounds
from burstwatch.llm.shared import with_workers

_CORE = np.zeros(256, dtype=bool)
_CORE[48:58] = _CORE[97:123] = True
_CORE[128:] = True
#: Bytes to either side of a find in which quotation marks are looked for, and words in a window.
QUOTE_REACH, WINDOW = 120, 20
_QUOTES = ('"'.encode(), "“".encode(), "”".encode(), "«".encode(), "»".encode(), "„".encode())
FEATURES = 9
#: Letters of a stem.
STEMS = range(5, 10)
_CAUGHT = -1  # in a state: a stem has been read with so many edits, whatever follows is a find
#: Least log-likelihood ratio of a term: one in some twenty million words reaches it by chance.
SIGNIFICANT = 30.0


def allowed_edits(term: bytes) -> int:
    size = len(term.decode())
    return 0 if size < 5 else 1 if size < 10 else 2


@lru_cache(1)
def _lower_case() -> np.ndarray:
    """The lower-case code point of each; of those that become several letters, themselves."""
    return np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)], np.int32)


def folded(word: bytes) -> str:
    """A word's letters in lower case, one for one."""
    text = word.decode(errors="replace")
    return text.lower() if text.isascii() else "".join(chr(_lower_case()[ord(c)]) for c in text)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many letters begin before each byte of UTF-8 (and in all), and the letters."""
    begins = (data & 0xC0) != 0x80
    number = np.concatenate([np.zeros(1, np.int64), np.cumsum(begins)])
    at = np.flatnonzero(begins)
    lead = data[at].astype(np.int32)
    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    points = lead & np.array([0, 127, 31, 15, 7], np.int32)[size]
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        points[more] = (points[more] << 6) | (data[np.minimum(at[more] + k, len(data) - 1)] & 63)
    return number, np.minimum(points, 0x10FFFF)


@lru_cache(4)
def _classes(letters: bytes) -> np.ndarray:
    """The class of every code point: the number of its lower-case form among the letters, from 1 on, or 0."""
    own = np.zeros(0x110000, np.int32)
    known = np.frombuffer(letters, np.int32)
    own[known] = np.arange(1, len(known) + 1)
    return own[_lower_case()]


@dataclass(frozen=True)
class Automaton:
    """``table[state, class of a letter]`` is the next state, 0 none; ``edits[state]`` is -1 where no term ends,
    ``caught[state]`` where no stem has been read. ``letters`` are the code points that have a class."""

    letters: np.ndarray
    table: np.ndarray
    edits: np.ndarray
    caught: np.ndarray
    longest: int


def build(terms: list[bytes], stems: list[bytes] = (), near_stems: bool = False) -> Automaton:
    """The deterministic product of the terms' trie and their Levenshtein automata, over code points.

    With ``near_stems`` a stem is also read with the edits that its length allows.
    """
    whole = {stem: allowed_edits(stem) if near_stems else 0 for stem in stems}
    children: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]  # edits allowed to the term that ends here
    reach: list[int] = [-1]  # most edits allowed to any term below
    stem_ends: dict[int, int] = {}  # edits allowed to the stem that ends here
    for term, most, is_stem in sorted({(t, allowed_edits(t), False) for t in terms} | {(t, e, True) for t, e in whole.items()}):
        node = 0
        reach[0] = max(reach[0], most)
        for letter in map(ord, folded(term)):
            if letter not in children[node]:
                children[node][letter] = len(children)
                children.append({})
                ends.append(-1)
                reach.append(-1)
            node = children[node][letter]
            reach[node] = max(reach[node], most)
        if is_stem:
            stem_ends[node] = most
        else:
            ends[node] = max(ends[node], most)
    letters = sorted({letter for below in children for letter in below})
    classes = {letter: i for i, letter in enumerate(letters, 1)}

    def closed(state: dict[int, int]) -> tuple:
        """With skipped letters of the term, and without what other entries make needless."""
        caught = state.get(_CAUGHT, 99)
        stack = [(node, edits) for node, edits in state.items() if node != _CAUGHT]
        best: dict[int, int] = {}
        while stack:
            node, edits = stack.pop()
            if edits > reach[node] or best.get(node, 99) <= edits:
                continue
            best[node] = edits
            if edits <= stem_ends.get(node, -1):
                caught = min(caught, edits)
            stack += [(child, edits + 1) for child in children[node].values()]
        ahead = [(node, edits) for node, edits in best.items() if edits < caught]
        return tuple(sorted(ahead if caught == 99 else [(_CAUGHT, caught), *ahead]))

    start = closed({0: 0})
    known, order = {(): 0, start: 1}, [(), start]
    rows = [np.zeros(len(letters) + 1, np.int32)]

    def number(state: tuple) -> int:
        if state not in known:
            known[state] = len(order)
            order.append(state)
        return known[state]

    at = 1
    while at < len(order):
        other: dict[int, int] = {}  # after a letter that no term has here
        wanted: dict[int, dict[int, int]] = {}
        for node, edits in order[at]:
            if node == _CAUGHT:
                other[node] = edits
                continue
            other[node] = min(other.get(node, 99), edits + 1)  # a letter too many
            for letter, child in children[node].items():
                other[child] = min(other.get(child, 99), edits + 1)
                reached = wanted.setdefault(letter, {})
                reached[child] = min(reached.get(child, 99), edits)
        row = np.full(len(letters) + 1, number(closed(other)), np.int32)
        for letter, reached in wanted.items():
            row[classes[letter]] = number(closed({**other, **{n: min(e, other[n]) for n, e in reached.items()}}))
        rows.append(row)
        at += 1
    caught = [min((e for n, e in state if n == _CAUGHT), default=-1) for state in order]
    edits = [min((e for n, e in state if n == _CAUGHT or e <= ends[n]), default=-1) for state in order]
    longest = max((len(folded(term)) for term in [*terms, *whole]), default=0) + 2
    return Automaton(np.array(letters, np.int32), np.stack(rows), np.array(edits, np.int8), np.array(caught, np.int8), longest)


def cores(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words without leading and trailing punctuation: starts, ends, text and place in the text."""
    starts, ends, first = word_bounds(chunk)
    core = _CORE[chunk.data]
    places = np.arange(len(core))
    following = np.minimum.accumulate(np.where(core, places, len(core))[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(core, places, -1))
    text = np.repeat(np.arange(len(chunk)), np.diff(first))
    place = np.arange(len(starts)) - first[:-1][text]
    begin, end = following[starts], preceding[ends - 1] + 1
    kept = begin < ends
    return begin[kept], end[kept], text[kept], place[kept]


def found_terms(chunk: Chunk, automaton: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, text, place among the text's words, edits) of every word that is a term or nearly one."""
    begin, end, text, place = cores(chunk) if len(chunk.data) else [np.zeros(0, np.int64)] * 4
    number, points = code_points(chunk.data)
    letter = _classes(automaton.letters.tobytes())[points]
    first, size = number[begin], number[end] - number[begin]
    edits = np.full(len(begin), -1, np.int8)
    active = np.flatnonzero(size > 0)
    state = np.ones(len(active), np.int32)
    for step in range(automaton.longest):
        if not len(active):
            break
        state = automaton.table[state, letter[first[active] + step]]
        over = size[active] == step + 1
        edits[active[over]] = automaton.edits[state[over]]
        going = ~over & (state > 0)
        active, state = active[going], state[going]
    edits[active] = automaton.caught[state]  # longer than any term, but perhaps begun with a stem
    hit = np.flatnonzero(edits >= 0)
    return begin[hit], text[hit], place[hit], edits[hit]


def features(chunk: Chunk, automaton: Automaton) -> np.ndarray:
    """A row per text: exact plain, exact quoted, near plain, near quoted (log counts), any, density, densest window,
    two or more, three or more."""
    rows = np.zeros((len(chunk), FEATURES))
    at, text, place, edits = found_terms(chunk, automaton)
    if not len(at):
        return rows
    raw = chunk.data.tobytes()
    for position, t, e in zip(at.tolist(), text.tolist(), edits.tolist()):
        low, high = int(chunk.offsets[t]), int(chunk.offsets[t + 1])
        before, after = raw[max(low, position - QUOTE_REACH) : position], raw[position : min(high, position + QUOTE_REACH)]
        # an odd number of marks before opens a quotation that is closed after
        quoted = sum(map(before.count, _QUOTES)) % 2 == 1 and any(q in after for q in _QUOTES)
        rows[t, 2 * (e > 0) + quoted] += 1
    words = np.bincount(text, minlength=len(chunk))
    near = np.searchsorted(text * (1 << 40) + place, text * (1 << 40) + place + WINDOW) - np.arange(len(text))
    np.maximum.at(rows[:, 6], text, near)
    size = np.maximum(np.diff(chunk.offsets), 1)
    rows[:, :4] = np.log1p(rows[:, :4])
    rows[:, 4] = words > 0
    rows[:, 5] = np.log1p(1000 * words / size)
    rows[:, 6] = np.log1p(rows[:, 6])
    rows[:, 7], rows[:, 8] = words >= 2, words >= 3
    return rows


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[bytes, ...]
    stems: tuple[bytes, ...]
    automaton: Automaton
    weights: np.ndarray
    bias: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -30, 30)))


def _featured(automaton: Automaton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                rows = features(chunk, automaton)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), *(pa.array(rows[:, i]) for i in range(FEATURES))],
                    names=["toxic", *(f"f{i}" for i in range(FEATURES))],
                )

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word or stem, which of them, whether toxic, texts) of each task's texts; a stem counts where two words have it."""
    counts: dict[tuple[str, bool, int], int] = {}
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            toxic = batch.column(0).slice(chunk.first, len(chunk)).to_pylist()
            raw = chunk.data.tobytes()
            begin, end, text, _ = cores(chunk) if len(chunk.data) else [np.zeros(0, np.int64)] * 4
            bounds = np.searchsorted(text, np.arange(len(chunk) + 1))
            for t in range(len(chunk)):
                own = slice(bounds[t], bounds[t + 1])
                words = [folded(raw[a:b]) for a, b in zip(begin[own].tolist(), end[own].tolist())]
                stems = Counter(w[:k] for w in words for k in STEMS if len(w) >= k)
                for word in set(words):
                    counts[word, False, toxic[t]] = counts.get((word, False, toxic[t]), 0) + 1
                for stem, n in stems.items():
                    if n >= 2:
                        counts[stem, True, toxic[t]] = counts.get((stem, True, toxic[t]), 0) + 1
    keys = list(counts)
    yield pa.RecordBatch.from_arrays([
        pa.array([k[0].encode() for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.bool_()),
        pa.array([k[2] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64()),
    ], names=["word", "stem", "toxic", "n"])


def fit(
    documents: DataFrame, labels: DataFrame, training: Column, text: str = "text", doc_id: str = "doc_id",
    toxic: str = "toxic", sample: int = 20_000, ratio: float = 20.0, stem_ratio: float = 8.0,
) -> ToxicityModel:
    """Learn from the labelled rows for which ``training`` (over ``doc_id``) holds.

    At most ``sample`` labels are used, chosen by a hash of the id, and each different text
    once. A term is a word in at least four toxic texts, at least ``ratio`` times as frequent
    there as in the others, and not by chance (``SIGNIFICANT``); for stems the bound is
    ``stem_ratio``, and no stem begins another. All terms and stems are kept.
    Null labels and texts teach nothing; with no labels every score is one half.
    """
    with_workers(documents)
    known = labels.where(F.col(toxic).isNotNull()).select(
        F.col("doc_id").alias("doc"), F.col(toxic).cast("int").alias("toxic")
    ).where(training)
    chosen = known.orderBy(F.xxhash64("doc"), "doc", "toxic").limit(sample)  # bounded: fit to broadcast
    rows = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where("length(text) > 0")
    rows = rows.join(F.broadcast(chosen), "doc").select("toxic", "text")
    rows = rows.groupBy(F.sha2("text", 256)).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    rows = rows.select("toxic", "text").persist()
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    counted = rows.mapInArrow(_words, "word binary, stem boolean, toxic int, n long").groupBy("word", "stem").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("c"),
    )
    telling = (F.col("t") + 0.5) / (n_toxic + 1) / ((F.col("c") + 0.5) / (n_clean + 1))
    part = lambda n, share: F.when(n > 0, n * F.log(n / ((F.col("t") + F.col("c")) * share))).otherwise(0.0)
    toxic_share = max(n_toxic, 1) / max(n_toxic + n_clean, 1)
    by_chance = 2 * (part(F.col("t"), toxic_share) + part(F.col("c"), max(1 - toxic_share, 1e-9)))
    least = F.when(F.col("stem"), stem_ratio).otherwise(ratio)
    found = counted.where((F.col("t") >= 4) & (telling >= least) & (by_chance >= SIGNIFICANT) & (F.length("word") >= 3))
    ordered = [(F.col("t") * F.log(telling)).desc(), F.length("word").desc(), "word"]
    found = [(r["stem"], bytes(r["word"])) for r in found.orderBy(*ordered).collect()]
    lexicon = tuple(word for stem, word in found if not stem)
    taken: dict[str, None] = {}
    begun: set[str] = set()  # what stems begin with
    for stem in (word.decode() for is_stem, word in found if is_stem):
        if stem not in begun and not any(stem[:k] in taken for k in STEMS):
            taken[stem] = None
            begun |= {stem[:k] for k in STEMS}
    stems = [stem.encode() for stem in taken]
    automaton = build(list(lexicon), stems, near_stems=True)
    fields = "toxic int, " + ", ".join(f"f{i} double" for i in range(FEATURES))
    table = rows.mapInArrow(_featured(automaton), fields).toPandas() if n_toxic + n_clean else None
    rows.unpersist()
    if table is None:
        return ToxicityModel(lexicon, tuple(stems), automaton, np.zeros(FEATURES), 0.0)
    table = table.sort_values(list(table.columns))
    weights, bias = _regression(table.iloc[:, 1:].to_numpy(), table["toxic"].to_numpy())
    return ToxicityModel(lexicon, tuple(stems), automaton, weights, bias)


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(documents: DataFrame, model: ToxicityModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, score, predicted, n_terms`` for every row; null and empty texts have the score of no finds.

    ``n_terms`` counts words within the allowed edits of a term. Repeated rows give equal
    rows, an empty table an empty result; other columns are not read.
    """
    rows = with_workers(documents).select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = features(chunk, model.automaton)
                value = model.scores(found)
                terms = np.rint(np.expm1(found[:, :4]).sum(axis=1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.first, len(chunk)), pa.array(value),
                    pa.array((value >= 0.5).astype(np.int32)), pa.array(terms),
                ], names=["doc_id", "score", "predicted", "n_terms"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_terms long")
