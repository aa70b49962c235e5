"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (one to three bytes of its lower-cased letters,
everything else a space), weighted by log term frequency times inverse document frequency
and scaled to length one. Every language has several centroids, found by spherical k-means
on a bounded sample; a text takes the language of the centroid with the largest cosine, and
is rejected if its distance exceeds what that centroid's own members reach.

Document frequencies come from all training rows. Only the clustering sees a sample: at most
``per_language`` rows of each language, chosen by a hash of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from burstwatch.llm.batches import Chunk, chunks
from burstwatch.llm.shared import with_workers

BUCKETS = 4096
UNKNOWN = "und"
_ROWS = 512
_KEPT = np.full(256, 32, dtype=np.uint8)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


def term_counts(chunk: Chunk) -> np.ndarray:
    """Counts of hashed n-grams, a row per text."""
    data = _KEPT[chunk.data].astype(np.uint32)
    text = np.repeat(np.arange(len(chunk), dtype=np.int64), np.diff(chunk.offsets))
    found = np.zeros(len(chunk) * BUCKETS)
    for n in (1, 2, 3):
        size = len(data) - n + 1
        if size <= 0:
            break
        gram, letter = np.full(size, n * 0x27D4EB2F, np.uint32), np.zeros(size, dtype=bool)
        for i in range(n):
            byte = data[i : i + size]
            gram = (gram ^ byte) * np.uint32(0x9E3779B1)
            gram ^= gram >> np.uint32(15)
            letter |= byte != 32
        letter &= text[:size] == text[n - 1 : n - 1 + size]
        at = text[:size] * BUCKETS + (gram * np.uint32(0x85EBCA6B) >> np.uint32(20)).astype(np.int64)
        found += np.bincount(at[letter], minlength=len(found))
    return found.reshape(len(chunk), BUCKETS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = (np.log1p(counts) * idf).astype(np.float32)
    length = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(length > 0, length, 1)


def clustered(points: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids by spherical k-means, started from points far from each other."""
    chosen = [int(np.argmax(points @ points.mean(axis=0)))]
    while len(chosen) < min(clusters, len(points)):
        nearest = (points @ points[chosen].T).max(axis=1)
        chosen.append(int(np.argmin(nearest)))
    centroids = points[chosen]
    for _ in range(rounds):
        own = (points @ centroids.T).argmax(axis=1)
        sums = np.stack([points[own == i].sum(axis=0) for i in range(len(centroids))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = (sums / np.where(length > 0, length, 1))[length[:, 0] > 0]
    return centroids


@dataclass(frozen=True)
class Centroids:
    """The model: a few centroids per language, each with the distance its members reach."""

    idf: np.ndarray
    languages: tuple[str, ...]
    centroids: np.ndarray
    reach: np.ndarray


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for chunk in chunks(batch.column(0), rows=_ROWS):
            found += (term_counts(chunk) > 0).sum(axis=0)
            rows += len(chunk)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, BUCKETS)), pa.array(np.concatenate([[rows], found]))], names=["bucket", "n"]
    )


#: log2 of the shares into which a language's rows are told apart when its sample is looked for.
_SHARES = 12


def _sampled(rows: DataFrame, per_language: int) -> DataFrame:
    """``lang, text`` of the ``per_language`` rows of each language with the smallest hashes of id and text; of fewer, all.

    How far up the hashes reach is found from counts per share of their range; what lies below
    that is cut to the number before it is shuffled. So neither a language whose rows share one id nor one
    text is lost, and none brings more rows than the number from any task.
    """
    hashed = rows.withColumn("hash", F.xxhash64("doc", "text", F.lit(1)))
    share = F.expr(f"shiftrightunsigned(hash, {64 - _SHARES})")
    counted = hashed.groupBy("lang", share.alias("share")).agg(F.count("*").alias("n"))
    below = F.sum("n").over(Window.partitionBy("lang").orderBy("share")) - F.col("n")
    reach = counted.withColumn("below", below).where(F.col("below") < per_language).groupBy("lang").agg(F.max("share").alias("reach"))
    # a row per language, whose number ``fit`` has checked
    near = hashed.join(F.broadcast(reach), "lang").where(share <= F.col("reach"))
    order = Window.partitionBy("lang").orderBy("hash", "text")
    return near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language).select("lang", "text")


def fit(
    documents: DataFrame, training: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    per_language: int = 2000, clusters: int = 4, languages: int = 2000,
) -> Centroids:
    """Learn from the rows for which ``training`` holds and the language is known.

    Of each language ``per_language`` rows are used, or all if it has fewer; ids and texts may be
    null or repeated, a repeated row counts as often as it is there. The model holds every language
    and goes to every task: 64 KB a language, so more than ``languages`` of them are an
    error, and so is a language with texts that ends up without a centroid.

    A null text, or one without a letter, teaches nothing; without any training row the model
    has no languages and predicts ``und``.
    """
    rows = with_workers(documents).where(training & F.col(lang).isNotNull()).select(
        F.col(doc_id).cast("string").alias("doc"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).where(F.col("text").rlike(r"\p{L}"))
    known = {r["lang"] for r in rows.select("lang").distinct().limit(languages + 1).collect()}
    if len(known) > languages:
        raise ValueError(f"more than {languages} languages")
    counted = rows.select("text").mapInArrow(_document_frequencies, "bucket long, n long")
    frequency = {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = frequency.get(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([frequency.get(i, 0) for i in range(BUCKETS)]))) + 0.1

    def cluster(key: tuple, table: pa.Table) -> pa.Table:
        points = _points(table.sort_by("text"), idf)  # whatever order the rows came in
        centroids = clustered(points, clusters)
        nearest = points @ centroids.T
        own, reach = nearest.argmax(axis=1), []
        for i in range(len(centroids)):
            members = 1 - nearest[own == i, i]
            reach.append(float(np.quantile(members, 0.995)) * 1.1 if len(members) else 0.0)
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(centroids)), "reach": pa.array(reach),
            "centroid": pa.array([c.astype(np.float32).tolist() for c in centroids], pa.list_(pa.float32())),
        })

    sample = _sampled(rows, per_language)
    found = sample.groupBy("lang").applyInArrow(cluster, "lang string, reach double, centroid array<float>").collect()
    missing = known - {r["lang"] for r in found}
    if missing:
        raise RuntimeError(f"no centroid for {sorted(missing)[:5]}")
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    return Centroids(
        idf, tuple(r["lang"] for r in found),
        np.array([r["centroid"] for r in found], np.float32).reshape(len(found), BUCKETS),
        np.array([r["reach"] for r in found], np.float32),
    )


def _points(table: pa.Table, idf: np.ndarray) -> np.ndarray:
    texts = pa.concat_arrays([c.cast(pa.large_string()) for c in table["text"].chunks])
    return np.concatenate([vectors(term_counts(chunk), idf) for chunk in chunks(texts, rows=_ROWS)])


def identify(
    documents: DataFrame, model: Centroids, text: str = "text", doc_id: str = "doc_id", reject: bool = True
) -> DataFrame:
    """``doc_id, lang_pred, score, distance, rejected`` for every row.

    ``score`` is the cosine with the nearest centroid, at least 0. A null or empty text, or
    one without a letter, is ``und`` with score 0; with ``reject`` so is a text farther from
    its centroid than ``reach`` (its score is kept). Among equal cosines the first language
    in text order wins. Repeated rows give equal rows; other columns are not read.
    """
    rows = with_workers(documents).select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for chunk in chunks(batch.column(1), rows=_ROWS):
                size, ids = len(chunk), batch.column(0).slice(chunk.first, len(chunk))
                if len(model.languages):
                    cosine = vectors(term_counts(chunk), model.idf) @ model.centroids.T
                    best = cosine.argmax(axis=1)
                    top = np.clip(cosine[np.arange(size), best], 0, 1).astype(float)
                    far = 1 - top > model.reach[best]
                else:
                    best, top, far = np.zeros(size, np.int64), np.zeros(size), np.ones(size, dtype=bool)
                none = ~_lettered(chunk)
                best[none | (far if reject else False)] = len(model.languages)
                top[none] = 0
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(names[best].tolist(), pa.string()), pa.array(top), pa.array(1 - top), pa.array(far | none)],
                    names=["doc", "lang_pred", "score", "distance", "rejected"],
                )

    found = rows.mapInArrow(run, f"doc {kind}, lang_pred string, score double, distance double, rejected boolean")
    return found.withColumnRenamed("doc", "doc_id")


def _lettered(chunk: Chunk) -> np.ndarray:
    """Whether each text has a letter of any script."""
    sums = np.concatenate([[0], np.cumsum((chunk.data >= 97) & (chunk.data <= 122))])
    found = sums[chunk.offsets[1:]] > sums[chunk.offsets[:-1]]
    for i in np.flatnonzero(~found):
        raw = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]]
        if (raw >= 128).any():
            found[i] = any(c.isalpha() for c in raw.tobytes().decode())
    return found
