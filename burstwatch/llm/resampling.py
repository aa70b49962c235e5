"""Importance resampling towards a target: hashed word runs, gains per bucket, Gumbel top-k.

A document's weight is the mean log ratio of how often its features' buckets occur in
the target and in the corpus; adding keyed Gumbel noise and taking the largest scores
draws documents without replacement in proportion to the ratio.

A bucket is a crc32, which is taken for all features of a chunk at once. The checksum is
linear over XOR but for a constant of the length: a byte contributes a value that depends
on it and on its distance from the feature's end, looked up in one table, and a feature's
checksum is the XOR over its bytes (``bitwise_xor.reduceat``) and the constant. Features
longer than the table are cut into blocks from their end, which are folded in pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from burstwatch.llm.batches import Chunk, chunks
from burstwatch.llm.shared import stored, with_workers

#: Distances from the end in the table, also the bytes of a block.
BLOCK = 64
#: Blocks whose bytes are looked up at once.
SLICE = 1 << 16
#: Rows that one task makes of a repeated row.
RUN = 10_000

U = np.uint32
_POLYNOMIAL, _ONES = U(0xEDB88320), U(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=U)
    for _ in range(8):
        x = np.where(x & U(1), (x >> U(1)) ^ _POLYNOMIAL, x >> U(1))
    return x


_BYTE = _byte_table()


def _behind(x: np.ndarray) -> np.ndarray:
    """The checksum register after one more zero byte."""
    return (x >> U(8)) ^ _BYTE[x & U(255)]


def _position_table() -> tuple[np.ndarray, np.ndarray]:
    """What a byte contributes by its distance from the end, and the constants of the lengths up to ``BLOCK``."""
    table, constants = np.empty((BLOCK, 256), U), np.empty(BLOCK + 1, U)
    x, state = _BYTE, np.array([_ONES])
    for i in range(BLOCK):
        table[i], constants[i] = x, state[0]
        x, state = _behind(x), _behind(state)
    constants[BLOCK] = state[0]
    return table.ravel(), constants


_POSITION, _CONSTANT = _position_table()


@lru_cache(64)
def _blocks_behind(level: int) -> np.ndarray:
    """For each byte of a register, the register after ``BLOCK * 2**level`` more zero bytes."""
    if level == 0:
        x = (np.arange(256, dtype=U)[None, :] << (U(8) * np.arange(4, dtype=U)[:, None])).ravel()
        for _ in range(BLOCK):
            x = _behind(x)
        return x.reshape(4, 256)
    return _moved(_blocks_behind(level - 1).ravel(), level - 1).reshape(4, 256)


def _moved(x: np.ndarray, level: int) -> np.ndarray:
    table = _blocks_behind(level)
    return table[0][x & U(255)] ^ table[1][(x >> U(8)) & U(255)] ^ table[2][(x >> U(16)) & U(255)] ^ table[3][x >> U(24)]


def _linear(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The XOR of the contributions of each span of 1 to ``BLOCK`` bytes."""
    found = np.empty(len(starts), U)
    for a in range(0, len(starts), SLICE):
        begin, end = starts[a : a + SLICE], ends[a : a + SLICE]
        size = end - begin
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(begin - first[:-1], size)
        far = np.repeat(end - 1, size) - at
        found[a : a + SLICE] = np.bitwise_xor.reduceat(_POSITION[far * 256 + data[at]], first[:-1])
    return found


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each span of bytes; spans may overlap, none is empty."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, U)
    if int(size.max()) <= BLOCK:
        return _linear(data, starts, ends) ^ _CONSTANT[size] ^ _ONES
    many = (size + BLOCK - 1) // BLOCK
    span = np.repeat(np.arange(len(size)), many)
    # blocks are numbered from the span's end
    nth = np.arange(len(span)) - np.repeat(np.cumsum(many) - many, many)
    last = ends[span] - nth * BLOCK
    x = _linear(data, np.maximum(last - BLOCK, starts[span]), last)
    level = 0
    while int(many.max()) > 1:
        odd = nth & 1 == 1
        x[odd] = _moved(x[odd], level)
        nth >>= 1
        heads = np.flatnonzero(np.concatenate([[True], (span[1:] != span[:-1]) | (nth[1:] != nth[:-1])]))
        x, span, nth = np.bitwise_xor.reduceat(x, heads), span[heads], nth[heads]
        many, level = (many + 1) // 2, level + 1
    constant, whole, level = _CONSTANT[size % BLOCK], size // BLOCK, 0
    while whole.any():
        odd = whole & 1 == 1
        constant[odd] = _moved(constant[odd], level)
        whole, level = whole >> 1, level + 1
    return x ^ constant ^ _ONES


_IN_WORD = np.zeros(256, bool)
for _a, _b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _IN_WORD[_a:_b] = True


def _words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts joined by one space, their starts and ends there, and each text's first word."""
    inside = _IN_WORD[chunk.data]
    cut = np.zeros(len(inside) + 1, bool)
    cut[chunk.offsets] = True
    starts = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | cut[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | cut[1:])) + 1
    size = ends - starts
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
    begin = np.cumsum(size + 1) - (size + 1)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = chunk.data[inside]
    return joined, begin, begin + size, np.searchsorted(starts, chunk.offsets)


def _features(chunk: Chunk, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each run length: the buckets of all runs, where each text's begin, and each text's words."""
    data, starts, ends, first = _words(chunk)
    words = np.diff(first)
    for n in range(1, longest + 1):
        many = np.maximum(words - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(many)])
        at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], many)
        yield crc32s(data, starts[at], ends[at + n - 1]) % U(buckets), bounds, words


def _counter(longest: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                for bucket, _, _ in _features(chunk, longest, buckets):
                    found += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """``bucket, n``: how many features of all rows fall into each bucket that has any; one row a task and bucket is shuffled."""
    found = with_workers(texts).select(F.col(text).cast("string").alias("text")).mapInArrow(
        _counter(longest, buckets), "bucket long, n long"
    )
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def fit(corpus: DataFrame, target: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Each bucket's gain: the floored thousandfold log ratio of its smoothed shares in ``target`` and ``corpus``.

    Only ``buckets`` numbers come to the driver. Null texts have no features; empty tables
    have the smoothed share one in ``buckets`` everywhere.
    """
    own = bucket_counts(corpus, text, longest, buckets).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, text, longest, buckets).withColumnRenamed("n", "t")
    rows = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    rows = rows.join(own, "bucket", "left").join(theirs, "bucket", "left").na.fill(0).toArrow()
    s, t = (rows.column(c).to_numpy().astype(float) for c in ("s", "t"))
    gains = np.zeros(buckets, np.int64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    gains[rows.column("bucket").to_numpy()] = np.floor(1000 * np.log(ratio)).astype(np.int64)
    return gains


def _weigher(gains: np.ndarray, longest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                total = features = np.zeros(len(chunk), np.int64)
                words = features
                for bucket, bounds, words in _features(chunk, longest, len(gains)):
                    sums = np.concatenate([[0], np.cumsum(gains[bucket])])
                    total = total + sums[bounds[1:]] - sums[bounds[:-1]]
                    features = features + np.diff(bounds)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                ids = batch.column(0).slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(a.astype(np.int64)) for a in (words, features, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Keyed Gumbel noise in thousandths; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(
    documents: DataFrame, gains: np.ndarray, text: str = "text", doc_id: str = "doc_id", longest: int = 1, seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row; a text without features has weight 0."""
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = with_workers(documents).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_weigher(gains, longest), f"doc_id {kind}, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def rank(rows: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """``rows`` of :func:`scored` with ``rank``: 1, 2, ... for the drawn ones, null for the others.

    Of the N rows with at least ``min_words`` words the ``percent * N // 100`` with the highest
    scores are drawn, ties to the smaller id (null first), then fewer words, features and weight; rows
    that agree in all of these are alike and take successive ranks. Scores are whole thousandths of
    logarithms of counts, so there are at most some 130,000 different ones at any size: how many
    rows lie above each is a small table, and each score's rows are put in order apart from the others'.
    """
    rows = stored(rows, "scored")
    fit_rows = rows.where(F.col("n_words") >= min_words)
    drawn = fit_rows.count() * percent // 100
    above = fit_rows.groupBy("score").agg(F.count("*").alias("here"))
    above = above.withColumn("before", F.sum("here").over(Window.orderBy(F.desc("score"))) - F.col("here"))
    near = rows.join(F.broadcast(above.where(F.col("before") < drawn).drop("here")), "score", "left").select(*rows.columns, "before")
    chosen = (F.col("n_words") >= min_words) & F.col("before").isNotNull()
    others = near.where(~chosen).select(*rows.columns, F.lit(None).cast("long").alias("rank"))
    keys = ["doc_id", "n_words", "n_features", "weight"]
    alike = near.where(chosen).groupBy(*rows.columns, "before").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("score").orderBy(*[F.asc_nulls_first(k) for k in keys])
    alike = alike.withColumn("first", F.col("before") + F.sum("copies").over(order) - F.col("copies"))
    # copies are written out run by run, so that one row with many of them is not one task's work
    runs = alike.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))))
    ends = F.least(F.col("run") + RUN, F.col("copies")) - 1
    ranks = runs.withColumn("nth", F.explode(F.sequence(F.col("run"), ends))).withColumn("rank", F.col("first") + F.col("nth") + 1)
    return others.unionByName(ranks.select(*rows.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")))


def resample(
    documents: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", longest: int = 1,
    buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``documents``.

    Features are all runs of 1 to ``longest`` words (letters, digits and everything beyond ASCII;
    A-Z lower-cased), joined by one space and counted with repeats. Null and empty texts have none and
    are never drawn with ``min_words`` above 0. Repeated ids are rows of their own that share their
    noise. Other columns are not read; empty tables give an empty result.
    """
    gains = fit(documents, target, text, longest, buckets)
    return rank(scored(documents, gains, text, doc_id, longest, seed), percent, min_words)
