"""Token counts of a unigram tokenizer without making its tokens.

Aho-Corasick finds every vocabulary piece in a segment; dynamic programming keeps, for each
position, the best score and the number of pieces that reach it. The rules are those of the
``tokenizers`` library's Unigram model: double scores; a character that no piece matches on
its own may be read as unknown for the lowest score less ten, and then counts as its UTF-8
bytes; pieces ending at one place are tried from the longest to the shortest, and only a
better score replaces one found before. Spaces are written as U+2581, one precedes the text,
and a segment begins at each, so a segment's count does not depend on its neighbours and a
task remembers the segments it has seen.

The scored vocabulary is read from a sentencepiece file; no tokenizer is trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from burstwatch.llm.shared import with_workers

SPACE = "▁"
#: Characters of the segments that a task remembers before it starts afresh, each counted with
#: what an entry takes beside them; and the longest segment that it remembers.
REMEMBERED, ENTRY, LONGEST = 128_000_000, 200, 64


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in the order of the ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Counter:
    """Best score and number of pieces of a segment."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(reversed(pieces)).items():  # of repeated pieces the first counts
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - 10.0
        self.seen: dict[str, tuple[float, int]] = {}
        self.held = 0

    def segment(self, text: str) -> tuple[float, int]:
        known = self.seen.get(text)
        if known is not None:
            return known
        size = len(text)
        best, count, single = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        reached = [False] * (size + 1)
        reached[0] = True
        done = 0
        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while done < end - 1:  # positions before ``end`` have had all their pieces
                done += 1
                self._unknown(text, done, best, count, reached, single)
            value = best[end - length] + score
            if not reached[end] or value > best[end]:
                best[end], count[end], reached[end] = value, count[end - length] + 1, True
            if length == 1:
                single[end] = True
        while done < size:
            done += 1
            self._unknown(text, done, best, count, reached, single)
        if size <= LONGEST:
            if self.held + size + ENTRY > REMEMBERED:
                self.seen.clear()
                self.held = 0
            self.held += size + ENTRY
            self.seen[text] = best[size], count[size]
        return best[size], count[size]

    def _unknown(self, text, end, best, count, reached, single) -> None:
        if not single[end]:
            value = best[end - 1] + self.unknown
            if not reached[end] or value > best[end]:
                best[end], reached[end] = value, True
                count[end] = count[end - 1] + len(text[end - 1].encode())

    def text(self, text: str) -> tuple[float, int]:
        """Score and pieces of a whole text; an empty one has none."""
        if not text:
            return 0.0, 0
        score, count, segment, seen = 0.0, 0, self.segment, self.seen.get
        for part in (text if text[0] in (" ", SPACE) else " " + text).replace(SPACE, " ").split(" ")[1:]:
            part = SPACE + part
            s, c = seen(part) or segment(part)
            score += s
            count += c
        return score, count


@lru_cache(2)
def _counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def count_tokens(documents: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, best_score`` for every row; null and empty texts have no tokens and score 0.

    Repeated rows give equal rows, an empty table an empty result; other columns are not read.
    """
    rows = with_workers(documents).select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [own.text(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c for _, c in found], pa.int64()), pa.array([s for s, _ in found])],
                    names=["doc_id", "n_tokens", "best_score"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, best_score double")
