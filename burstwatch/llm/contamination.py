"""Benchmark decontamination: size-partitioned MinHash containment, verified exactly.

Test items are short and documents long, so the sketch is taken of the item: the
``K`` smallest of its shingle hashes, under one hash order for all. Items are partitioned
by size (powers of two), and K follows from the partition's largest size and the
threshold: an item of q shingles of which ``percent`` % occur in a document lacks at most
(100 - percent) % of q of them, so with K one above that, at least one sketch entry is
among the document's shingles. No passage at or above the threshold can be missed.

Tasks over the documents keep the shingles that may be an item's, by a bit array of fixed size,
and mark those that may be a sketch entry, by a second one. The marked ones, joined with the
sketches, give the pairs of document id and item that are searched further, whichever row of
the id the hit was in. Only for these pairs the item's shingles are looked up among those of the
id and counted, which is the exact containment. Bit arrays of a fixed size stay the same however
many items there are; when they fill up, more rows travel and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from burstwatch.llm.batches import marked, shingle_sets, shingled_chunks
from burstwatch.llm.shared import bit_array, fresh, stored, with_workers

def _partition_of(size: int) -> int:
    """The largest size in the partition of items that holds ``size``."""
    return 1 << max(0, (size - 1).bit_length())


def sketch_size(size: int, percent: int) -> int:
    return min(size, _partition_of(size) * (100 - percent) // 100 + 1)


def _item_shingles(width: int, percent: int):
    """(item, shingle, whether in the sketch, shingles of the item, words of a shingle)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in shingled_chunks(batch.column(1)):
                found, bounds = shingle_sets(chunk, width)
                size = np.diff(bounds)
                text = np.repeat(np.arange(len(chunk)), size)
                rank = np.arange(len(found)) - np.repeat(bounds[:-1], size)
                most = np.array([sketch_size(int(n), percent) for n in size], dtype=np.int64)
                words = np.array([min(width, len(t.split())) for t in _texts(chunk)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)).take(pa.array(text)), pa.array(found.view(np.int64)),
                     pa.array(rank < most[text]), pa.array(size[text]), pa.array(words[text])],
                    names=["item", "shingle", "sketch", "n_item", "n_shingle_words"],
                )

    return run


def _texts(chunk) -> list[bytes]:
    raw = chunk.data.tobytes()
    return [raw[a:b] for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist())]


def _hits(widths: list[int], sketch: bytes, whole: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in shingled_chunks(batch.column(1)):
                docs, hashes = [], []
                for width in widths:
                    found, bounds = shingle_sets(chunk, width)
                    text = np.repeat(np.arange(len(chunk)), np.diff(bounds))
                    kept = marked(whole, found)
                    docs.append(text[kept])
                    hashes.append(found[kept])
                row = batch.column(0).slice(chunk.first, len(chunk))
                found = np.concatenate(hashes)
                yield pa.RecordBatch.from_arrays(
                    [row.take(pa.array(np.concatenate(docs))), pa.array(found.view(np.int64)), pa.array(marked(sketch, found))],
                    names=["doc", "shingle", "hit"],
                )

    return run


def contained_items(
    documents: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", width: int = 5, percent: int = 80,
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared`` of all documents that hold at least ``percent`` % of an item.

    Counted are an item's distinct ``width``-word shingles after lower-casing A-Z; an item with
    fewer words is one shingle of all its words, looked up among the documents' shingles of that
    length. Null, empty and wordless texts neither hold nor are held. Repeated document or item
    ids count as one text holding the shingles of all its rows, and ``n_item`` counts the different
    ones of them (so repeated item rows count once). A null id takes part as a value of its own. Empty tables give an empty result. Other columns are not read.
    """
    with_workers(documents)
    items = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).distinct()
    kind = items.schema["item"].dataType.simpleString()
    shingles = stored(items.mapInArrow(
        _item_shingles(width, percent),
        f"item {kind}, shingle long, sketch boolean, n_item long, n_shingle_words long",
    ), "items")
    widths = sorted(r[0] for r in shingles.select("n_shingle_words").distinct().collect())  # at most ``width``
    doc_kind = documents.schema[doc_id].dataType.simpleString()
    hits = stored(documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).mapInArrow(
        _hits(widths or [width], bit_array(shingles.where("sketch"), "shingle"), bit_array(shingles, "shingle")),
        f"doc {doc_kind}, shingle long, hit boolean",
    ).distinct(), "hits")
    # an item row's shingles; several rows of one id add up
    held = shingles.groupBy("item", "shingle").agg(F.max("sketch").alias("sketch"))
    size = held.groupBy("item").agg(F.count("*").alias("n_item"))
    pairs = hits.where("hit").join(held.where("sketch"), "shingle").select("doc", "item").distinct()
    asked = pairs.withColumnRenamed("item", "of").join(held.select("item", F.col("shingle").alias("asked")), F.col("of").eqNullSafe(F.col("item")))
    owned = hits.select(F.col("doc").alias("owner"), "shingle")
    found = asked.join(owned, F.col("doc").eqNullSafe(F.col("owner")) & (F.col("asked") == F.col("shingle")))
    found = found.groupBy("doc", "item").agg(F.count("*").alias("n_shared"))
    size = size.withColumnRenamed("item", "of")
    found = found.join(size, F.col("item").eqNullSafe(F.col("of"))).where(100 * F.col("n_shared") >= percent * F.col("n_item"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_item", "n_shared")


def drop_contaminated(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``documents`` whose id holds no item, with their columns as they were."""
    found = contained_items(documents, items, doc_id=doc_id, **options).select("doc_id").distinct()
    own = fresh("held", documents.columns)
    found = found.withColumnRenamed("doc_id", own)
    return documents.join(found, F.col(doc_id).eqNullSafe(F.col(own)), "left_anti")
