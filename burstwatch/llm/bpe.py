"""Byte-pair encoding and decoding with tree concatenation for long unsplit text.

Most texts are encoded whole. A text over ``leaf`` characters is cut into leaves that
tasks encode in parallel. A cut before white space that follows a letter or digit is a
place where the pre-tokenizer splits in any context, so encodings meet there without
further work. Text without such places is cut at the pre-tokenizer's own splits, and a
single pre-token longer than a leaf is cut anywhere: its halves are encoded on their own
and joined in a tree. At each join the last tokens of the left and the first of the right
half are encoded anew, in a window that doubles until its outermost tokens are those of
either side and each is what the pair with its outer neighbour encodes to. A sequence
whose neighbouring pairs all encode to themselves is the encoding of the whole, so the
result equals that of one pass.

The file is a byte-level BPE in the ``tokenizers`` format. Encoding goes through tiktoken
with the file's own vocabulary, which gives the same ids about three times as fast; a file
whose merges are not in the order of its ids is refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from burstwatch.llm.shared import fresh, with_workers

#: Characters above which a text is encoded in parts.
LEAF = 32_768
#: The pre-tokenizer's pattern and the byte letters of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        order = [vocab[a + b] for a, b in merges]
        if spec["pre_tokenizer"].get("type") != "ByteLevel" or order != sorted(order):
            raise ValueError(f"{path} is not a byte-level BPE with merges in the order of its ids")
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.bytes_of = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.splitter = Tokenizer.from_file(path).pre_tokenizer

    def whole(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype(np.int32)

    def unsplit(self, piece: bytes) -> list[int]:
        """The ids of one pre-token, or of a part of it."""
        return self.encoding._encode_single_piece(piece) if piece else []

    def text(self, ids: list[int]) -> str:
        """Ids that the file does not have are skipped; broken UTF-8 becomes U+FFFD."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(path)


@dataclass
class Leaf:
    """A part of a text: ordinary text in one piece, or pre-tokens that are encoded one by one.

    ``continues``: its one pre-token is the rest of the leaf before.
    """

    pieces: list[bytes]
    ordinary: bool = False
    continues: bool = False


def _sure(text: str, at: int) -> bool:
    """Whether the pre-tokenizer splits before ``at`` whatever the context."""
    return text[at] in " \n" and text[at - 1].isalnum()


def leaves(text: str, own: Codec, leaf: int) -> Iterator[Leaf]:
    """The parts of a text in order."""
    start = 0
    while len(text) - start > leaf:
        at = start + leaf
        while at > start + leaf // 2 and not _sure(text, at):
            at -= 1
        if at > start + leaf // 2:
            yield Leaf([text[start:at].encode()], ordinary=True)
        else:  # no sure place in reach: the run up to the next one is taken apart
            at = start + 1
            while at < len(text) and not _sure(text, at):
                at += 1
            yield from _run(text[start:at], own, leaf)
        start = at
    if start < len(text):
        yield Leaf([text[start:].encode()], ordinary=True)


def _run(run: str, own: Codec, leaf: int) -> Iterator[Leaf]:
    """A run without sure places: cut at special tokens, at the splitter's splits, then anywhere."""
    for i, part in enumerate(re.split("|".join(map(re.escape, own.special)), run) if own.special else [run]):
        if i:
            special = next(s for s in own.special if run.startswith(s, at))
            yield Leaf([special.encode()], ordinary=True)
            at += len(special)
        else:
            at = 0
        yield from _pre_tokens(part, own, leaf)
        at += len(part)


def _pre_tokens(part: str, own: Codec, leaf: int) -> Iterator[Leaf]:
    gathered, size = [], 0
    for _, (a, b) in own.splitter.pre_tokenize_str(part) if part else []:
        piece = part[a:b].encode()
        if gathered and size + len(piece) > leaf:
            yield Leaf(gathered)
            gathered, size = [], 0
        if len(piece) <= leaf:
            gathered.append(piece)
            size += len(piece)
            continue
        step = -(-len(piece) // -(-len(piece) // leaf))
        for i in range(0, len(piece), step):
            yield Leaf([piece[i : i + step]], continues=i > 0)
    if gathered:
        yield Leaf(gathered)


def join(own: Codec, left: list[int], right: list[int]) -> list[int]:
    """The encoding of two neighbouring parts of one pre-token from the encodings of both."""
    if not left or not right:
        return left + right
    size = 2
    while True:
        a, b = left[-size:], right[:size]
        window = own.unsplit(b"".join(own.bytes_of[i] for i in a + b))
        outer_left, outer_right = left[: -len(a)], right[len(b) :]
        if (not outer_left or (window[0] == a[0] and _stays(own, outer_left[-1], window[0]))) and (
            not outer_right or (window[-1] == b[-1] and _stays(own, window[-1], outer_right[0]))
        ):
            return outer_left + window + outer_right
        size *= 2


def _stays(own: Codec, a: int, b: int) -> bool:
    return own.unsplit(own.bytes_of[a] + own.bytes_of[b]) == [a, b]


def tree(own: Codec, parts: list[list[int]]) -> list[int]:
    """Join neighbours, then the joined, until one is left."""
    while len(parts) > 1:
        parts = [join(own, *parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _lists(found: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _rowwise(at: int, make: Callable) -> Callable:
    """Append a column made from column ``at``, a few hundred rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                names = [f"c{i}" for i in range(part.num_columns + 1)]
                yield pa.RecordBatch.from_arrays([*part.columns, make(part.column(at))], names=names)

    return run


def _ddl(rows: DataFrame, added: str) -> str:
    fields = [f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(rows.schema)]
    return ", ".join([*fields, f"`c{len(fields)}` {added}"])


def encode(documents: DataFrame, path: str, text: str = "text", ids: str = "ids", leaf: int = LEAF) -> DataFrame:
    """``documents`` with the token ids of ``text`` as an array column ``ids``.

    A null or empty text has no ids. Strings of special tokens in a text become those
    tokens, as the file's own library does. Repeated rows stay repeated; a long text that
    repeats is encoded once. An older column ``ids`` is replaced; ``path`` is read in the
    tasks and must exist on every executor.
    """
    documents = with_workers(documents).drop(ids)
    names, at = documents.columns, documents.columns.index(text)

    def back(rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate([*names, ids])))

    def whole(column: pa.Array) -> pa.Array:
        own = codec(path)
        return _lists([own.whole(t) if t else np.zeros(0, np.int32) for t in column.to_pylist()])

    is_long = F.coalesce(F.length(text), F.lit(0)) > leaf
    short = documents.where(~is_long)
    encoded = back(short.mapInArrow(_rowwise(at, whole), _ddl(short, "array<int>")))

    key = fresh("digest", [*names, ids])
    digest = F.sha2(F.col(text), 256).alias(key)
    lengthy = documents.where(is_long)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for value in batch.column(0):
                value = value.as_py()
                parts = list(leaves(value, own, leaf))
                yield pa.RecordBatch.from_arrays([
                    pa.array([hashlib.sha256(value.encode()).hexdigest()] * len(parts)), pa.array(range(len(parts)), pa.int32()),
                    pa.array([p.continues for p in parts]), pa.array([p.ordinary for p in parts]),
                    pa.array([p.pieces for p in parts], pa.list_(pa.binary())),
                ], names=["key", "nth", "continues", "ordinary", "pieces"])

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in _slices(batch):
                found = [
                    own.whole(pieces[0].decode()) if ordinary else np.array([i for p in pieces for i in own.unsplit(p)], np.int32)
                    for ordinary, pieces in zip(part.column(3).to_pylist(), part.column(4).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], _lists(found)], names=["key", "nth", "continues", "ids"])

    def assemble(table: pa.Table) -> pa.Table:
        own, table = codec(path), table.sort_by("nth")
        done, open_parts = [], []
        for continues, part in zip(table["continues"].to_pylist(), table["ids"]):
            if not continues and open_parts:
                done.append(_tree_array(own, open_parts))
                open_parts = []
            open_parts.append(np.asarray(part.values, dtype=np.int32))
        done.append(_tree_array(own, open_parts))
        return pa.table({"key": table["key"].slice(0, 1), "ids": _lists([np.concatenate(done)])})

    parts = lengthy.select(text, digest).dropDuplicates([key]).select(text).mapInArrow(
        split, "key string, nth int, continues boolean, ordinary boolean, pieces array<binary>"
    )
    tokens = parts.repartition("key", "nth").mapInArrow(
        encode_leaves, "key string, nth int, continues boolean, ids array<int>"
    ).groupBy("key").applyInArrow(assemble, "key string, ids array<int>")
    tokens = tokens.select(F.col("key").alias(key), F.col("ids").alias(ids))
    lengthy = lengthy.withColumn(key, digest).join(tokens, key).select(*names, ids)
    return encoded.unionByName(lengthy)


def _tree_array(own: Codec, parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.array(tree(own, [p.tolist() for p in parts]), np.int32)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids as a column ``text``, special tokens included; null ids give an empty text."""
    rows = with_workers(rows).drop(text)
    names, at = rows.columns, rows.columns.index(ids)

    def make(column: pa.Array) -> pa.Array:
        own = codec(path)
        return pa.array([own.text(x) if x else "" for x in column.to_pylist()], pa.string())

    done = rows.mapInArrow(_rowwise(at, make), _ddl(rows, "string"))
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate([*names, text])))
