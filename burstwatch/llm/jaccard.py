"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

Two documents link when their sets of word shingles have a Jaccard similarity of at
least ``percent`` / 100. The join is exact and has no cap:

1. Every document becomes a sorted set of shingle hashes; equal sets are one class.
2. Sizes fall into bands. Linked sets of band sizes up to M differ in at most
   k = (100 - percent) / (100 + percent) * 2M shingles. Cutting the hash range into
   k + 1 + s groups leaves at least s + 1 groups equal, so two linked sets share a tile:
   (band, group, digest of the group's shingles). Empty groups make no tile; a set with
   more than s of them joins its band's own small tile as well, so no pair is lost.
   Sets within reach of the next band's sizes are dealt into that band's tiles too.
3. In a tile, bit counts of 1024-bit parity signatures bound the difference from below
   and so the overlap from above; what may reach the threshold is verified exactly by
   intersecting the sorted hash arrays.
4. Each set is compared with two leaders of its tile first; those not in the tile's largest
   component then with a few members of that. After that only members
   outside the tile's largest component meet the other components, so that a tile of
   thousands of near copies costs thousands of comparisons and not their square.
   Tiles with the same members are one tile. Arrays are made only for pairs that pass
   the bit counts, and meet only after a second signature, of two bits a shingle and more,
   has bounded the overlap of long sets, whose 1024 bits are full.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from burstwatch.llm.batches import U, marked, mixed, shingle_sets, shingled_chunks, summed
from burstwatch.llm.components import connected_components
from burstwatch.llm.shared import bit_array, stored, with_workers

#: Ratio of the sizes at a band's ends.
BAND = 1.4
#: 64-bit words of a bitmap signature.
WORDS = 16
#: Leaders with which each member of a tile is compared first.
LEADERS = 2
#: Members of a tile's largest component with which those outside it are compared next.
HEADS = 6
_NUMBERS = ["size", "id", "id2"]
_SIGNATURE = [f"w{i}" for i in range(WORDS)]
_TILES = pa.schema([("tile", pa.int64()), ("id", pa.int64())])
_ARRAYS = pa.schema([("id", pa.int64()), ("size", pa.int64()), ("bits", pa.binary()), ("shingles", pa.list_(pa.int64()))])


@lru_cache(None)
def bands(percent: int, largest: int) -> list[tuple[int, int, int]]:
    """(smallest size, groups, spare groups) of each band up to a size of ``largest``."""
    found, low = [], 1
    while low <= largest:
        high = max(low + 1, int(low * BAND))
        differ = (100 - percent) * 2 * (high - 1) // (100 + percent)
        spare = 0
        for _ in range(20 if differ else 0):
            groups = differ + 1 + spare
            empty = groups * (1 - 1 / groups) ** max(1, low * percent // 100)
            spare = int(empty + 3 * empty**0.5) + 1
        found.append((low, differ + 1 + spare, spare))
        low = high
    return found


def _sets(width: int, at: int, signature: bool, wanted: bytes | None = None, inside: bool = True):
    """Append size, id and, if asked for, the signature of the text in column ``at``.

    With an array ``wanted`` only rows whose id is marked in it, or is not, are given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in shingled_chunks(batch.column(at)):
                found, bounds = shingle_sets(chunk, width)
                size = np.diff(bounds)
                ids, ids2 = _ids(found, bounds)
                added = [size, ids.view(np.int64), ids2.view(np.int64)]
                if signature:
                    text = np.repeat(np.arange(len(chunk)), size)
                    bits = np.bincount(
                        text * (64 * WORDS) + (found >> U(54)).astype(np.int64), minlength=len(chunk) * 64 * WORDS
                    )
                    words = np.packbits((bits & 1).astype(np.uint8)).view(np.int64).reshape(len(chunk), WORDS)
                    added += [np.ascontiguousarray(words[:, i]) for i in range(WORDS)]
                kept = [c.slice(chunk.first, len(chunk)) for c in batch.columns]
                if signature:
                    del kept[at]
                names = _NUMBERS + _SIGNATURE * signature
                given = pa.RecordBatch.from_arrays(
                    kept + [pa.array(x) for x in added], names=[f"c{i}" for i in range(len(kept))] + names
                )
                if wanted is not None:
                    given = given.filter(pa.array((marked(wanted, ids) & (size > 0)) == inside))
                yield given

    return run


def _ids(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(bounds).astype(U)
    return mixed(summed(mixed(found, 21), bounds) + size, 22), mixed(summed(mixed(found, 23), bounds) + size, 24)


def _tiles(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a set that this task has dealt out already needs no second dealing
        for batch in batches:
            for chunk in shingled_chunks(batch.column(0)):
                found, bounds = shingle_sets(chunk, width)
                size = np.diff(bounds)
                if not size.any():
                    continue
                ids, _ = _ids(found, bounds)
                new = np.zeros(len(ids), dtype=bool)
                for i, x in enumerate(ids.tolist()):
                    if size[i] and x not in seen:
                        seen.add(x)
                        new[i] = True
                scheme = bands(percent, 2 << int(size.max()).bit_length())
                low, groups, spare = (np.array(x) for x in zip(*scheme))
                band = np.searchsorted(low, size, side="right") - 1
                following = np.minimum(band + 1, len(low) - 1)
                upper = new & (100 * size >= percent * low[following]) & (following > band)
                for chosen, own in ((new, band), (upper, following)):
                    chosen = chosen & (groups[own] > 1)
                    if chosen.any():
                        yield _dealt(found, size, bounds, ids, chosen, own, groups, spare)

    return run


def _dealt(found, size, bounds, ids, chosen, own, groups, spare) -> pa.RecordBatch:
    at = np.flatnonzero(chosen)
    text = np.repeat(np.arange(len(at)), size[at])
    start = np.concatenate([[0], np.cumsum(size[at])])
    hashes = found[np.arange(start[-1]) + np.repeat(bounds[at] - start[:-1], size[at])]
    # sorted hashes scaled to 0..groups-1 are sorted too, so a group is a run
    group = ((hashes >> U(32)) * groups[own[at]].astype(U)[text]) >> U(32)
    edge = np.ones(len(hashes), dtype=bool)
    edge[1:] = (group[1:] != group[:-1]) | (text[1:] != text[:-1])
    runs = np.flatnonzero(edge)
    content = summed(mixed(hashes, 31), np.concatenate([runs, [len(hashes)]]))
    of = text[runs]
    tile = mixed(mixed(content, 32) + own[at][of].astype(U) * U(0x100000001B3) + group[runs] * U(0x9E3779B97F4A7C15), 33)
    lacking = groups[own[at]] - np.bincount(of, minlength=len(at)) > spare[own[at]]
    tile = np.concatenate([tile, mixed(own[at][lacking].astype(U), 34)])
    member = np.concatenate([ids[at][of], ids[at][lacking]])
    return pa.RecordBatch.from_arrays([pa.array(tile.view(np.int64)), pa.array(member.view(np.int64))], schema=_TILES)


def long_signature(found: np.ndarray) -> bytes:
    """Parity bits of a set's hashes: a power of two of them, at least two a hash."""
    width = max(10, (2 * len(found) - 1).bit_length())
    bits = np.bincount((found >> U(64 - width)).astype(np.int64), minlength=1 << width)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two long signatures differ, the longer folded to the shorter's length."""
    one, two = sorted((np.unpackbits(np.frombuffer(x, np.uint8)) for x in (a, b)), key=len)
    if len(two) > len(one):
        two = np.bitwise_xor.reduce(two.reshape(len(one), -1), axis=1)
    return int(np.count_nonzero(one != two))


def _arrays(width: int, wanted: bytes):
    """(id, size, long signature, sorted shingles) of the texts whose id is marked in ``wanted``, each id once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for chunk in shingled_chunks(batch.column(0)):
                found, bounds = shingle_sets(chunk, width)
                ids, _ = _ids(found, bounds)
                for i in np.flatnonzero(marked(wanted, ids)).tolist():
                    if (x := int(ids[i])) not in seen:
                        seen.add(x)
                        own = found[bounds[i] : bounds[i + 1]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[i : i + 1].view(np.int64)), pa.array([len(own)], pa.int64()),
                             pa.array([long_signature(own)], pa.binary()), pa.array([own.view(np.int64)], pa.list_(pa.int64()))],
                            schema=_ARRAYS,
                        )

    return run


def _near(percent: int):
    """Keep pairs whose long signatures differ in no more bits than those of a linked pair may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            differ = [differing_bits(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))]
            keep = (100 + percent) * np.array(differ, dtype=np.int64) <= (100 - percent) * both
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _verified(percent: int):
    """Keep pairs whose sorted arrays intersect in enough shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            sides = []
            for side in (2, 3):
                column = batch.column(side)
                sides.append((column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).view(U)))
            (fa, va), (fb, vb) = sides
            for i in range(batch.num_rows):
                a, b = va[fa[i] : fa[i + 1]], vb[fb[i] : fb[i + 1]]
                both = len(a) + len(b)
                merged = np.concatenate([a, b])
                merged.sort()
                shared = int(np.count_nonzero(merged[1:] == merged[:-1]))
                keep[i] = 100 * shared >= percent * (both - shared)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _may_link(percent: int, a: str = "a", b: str = "b"):
    """Sizes within reach, and no more differing signature bits than a linked pair may have."""
    differ = sum((F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}"))) for i in range(1, WORDS)),
                 F.bit_count(F.col(f"{a}.w0").bitwiseXOR(F.col(f"{b}.w0"))))
    sizes = F.col(f"{a}.size") + F.col(f"{b}.size")
    near = 100 * F.least(f"{a}.size", f"{b}.size") >= percent * F.greatest(f"{a}.size", f"{b}.size")
    return near & ((100 + percent) * differ <= (100 - percent) * sizes)


def _labelled(documents: DataFrame, text: str, doc_id: str, width: int, percent: int) -> DataFrame:
    """``doc, size, id, id2, part, component_id`` for every row.

    ``id`` and ``id2`` are the halves of a set's 128-bit digest; ``part`` is the smallest ``id``
    reachable by links, null without words.
    """
    documents = with_workers(documents).select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = documents.schema["doc"].dataType.simpleString()
    numbers = ", ".join(f"{n} long" for n in _NUMBERS + _SIGNATURE)
    sets = stored(documents.mapInArrow(_sets(width, 1, True), f"doc {kind}, {numbers}"), "sets")
    classes = stored(sets.where("size > 0").groupBy("id", "id2").agg(
        F.min("doc").alias("doc"), F.first("size").alias("size"), *(F.first(w).alias(w) for w in _SIGNATURE)
    ), "classes")

    tiles = documents.select("text").mapInArrow(_tiles(width, percent), "tile long, id long")
    # a repeated text is dealt to all its tiles alike, so sums over equal members are equal;
    # two tiles that agree by chance become one with the members of both
    members = tiles.selectExpr(
        "tile", "id", "min(id) over (partition by tile) least", "max(id) over (partition by tile) most",
        "sum(hash(id)) over (partition by tile) sum1", "sum(hash(id, 1)) over (partition by tile) sum2",
    ).where("least <> most").selectExpr("xxhash64(least, most, sum1, sum2) tile", "id").distinct()
    members = stored(members, "members")
    sizes = classes.select("id", "size", *_SIGNATURE)

    def verified(pairs: DataFrame) -> DataFrame:
        """Those pairs of ids, each once with the smaller first, that link."""
        pairs = stored(
            pairs.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct(), "pairs"
        )
        # only the texts of pairs become arrays: a bit array of fixed size lets them pass
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        texts = documents.select("text").mapInArrow(
            _arrays(width, bit_array(ids, "id")), "id long, size long, bits binary, shingles array<long>"
        )
        arrays = stored(texts.dropDuplicates(["id"]).join(ids, "id", "left_semi"), "arrays")

        def both(pairs: DataFrame, *columns: str) -> DataFrame:
            a, b = (arrays.select(F.col("id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns)) for x in "ab")
            return pairs.join(a, "a").join(b, "b").select("a", "b", *(f"{c}_{x}" for c in columns for x in "ab"))

        near = stored(both(pairs, "size", "bits").mapInArrow(_near(percent), "a long, b long"), "near")
        return both(near, "shingles").mapInArrow(_verified(percent), "a long, b long")

    leaders = members.groupBy("tile").agg(*(
        F.min_by("id", F.xxhash64("id", F.lit(i))).alias(f"leader{i}") for i in range(LEADERS)
    ))
    leaders = leaders.select("tile", F.explode(F.array_distinct(F.array(*(f"leader{i}" for i in range(LEADERS))))).alias("y"))
    led = members.withColumnRenamed("id", "x").join(leaders, "tile").where("x <> y").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")
    ).distinct()
    led = led.join(sizes.alias("a"), F.col("x") == F.col("a.id")).join(sizes.alias("b"), F.col("y") == F.col("b.id"))
    led = led.where(_may_link(percent))
    links = stored(verified(led), "links")

    def placed(members: DataFrame, links: DataFrame) -> DataFrame:
        """The members of tiles of several parts, with their part and the tile's largest.

        Rows of one part are linked; two rounds of labels leave few components in several parts.
        """
        parts = connected_components(links, rounds=2).withColumnRenamed("node", "id")
        own = members.join(parts, "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
        several = own.groupBy("tile", "part").agg(F.count("*").alias("n")).groupBy("tile").agg(
            F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts")
        ).where("parts > 1").select("tile", "main")
        return stored(own.join(several, "tile").join(sizes, "id"), "placed")

    # those outside the main part meet some of its members before they meet all
    first = placed(members, links)
    heads = first.where("part = main").groupBy("tile").agg(
        F.array_distinct(F.array(*(F.min_by("id", F.xxhash64("id", F.lit(LEADERS + i))) for i in range(HEADS)))).alias("y")
    ).select("tile", F.explode("y").alias("y")).join(sizes.withColumnRenamed("id", "y"), "y").withColumnRenamed("y", "id")
    met = first.where("part <> main").alias("a").join(heads.alias("b"), "tile").where(_may_link(percent))
    links = stored(links.unionByName(verified(met)), "links")
    rows = placed(first.select("tile", "id"), links)  # tiles of one part stay so
    # a pair of two parts is met once: from outside the main part, or from the smaller id
    rest = rows.where("part <> main").alias("a").join(rows.alias("b"), "tile").where(
        (F.col("a.part") != F.col("b.part"))
        & ((F.col("b.part") == F.col("b.main")) | (F.col("a.id") < F.col("b.id"))) & _may_link(percent)
    )
    links = stored(links.unionByName(verified(rest)), "links")
    parts = connected_components(links).withColumnRenamed("node", "id")
    named = classes.select("id", "id2", "doc").join(parts, "id")
    lowest = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    # a part of one is named after its own rows, also when their id is null
    named = classes.select("id", "id2", "doc").join(
        named.join(lowest, "component").select("id", "id2", "component", "component_id"), ["id", "id2"], "left"
    ).select(
        "id", "id2", F.coalesce("component", "id").alias("part"), F.coalesce("component_id", "doc").alias("component_id")
    )
    return sets.select("doc", *_NUMBERS).join(named, ["id", "id2"], "left").withColumn(
        "component_id", F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc"))
    )


def near_duplicates(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 4, percent: int = 85
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row for every row of ``documents``.

    Words are runs of other than the space and 0x09-0x0D after lower-casing A-Z; a set holds
    the distinct ``width``-word shingles, or all words as one if there are fewer. Rows link
    when 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest id
    reachable by links, null where every id reachable is null. A null or empty text, or one
    without words, has ``n_shingles`` 0, links to nothing and is its own component. Repeated
    rows and ids give a row each; an empty table gives an empty result. Other columns are
    not read, whatever their names.
    """
    return _labelled(documents, text, doc_id, width, percent).select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id"
    )


def keep_one(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns.

    The row with the smallest id stays (a null id only where the group has no other);
    among rows that share it, one of the smallest digest. Rows without words all stay.
    """
    labelled = _labelled(documents, text, doc_id, width, percent)
    keys = ["part", "doc", "id", "id2"]
    keyed = stored(labelled.where("size > 0").groupBy(*keys).agg(F.count("*").alias("n")), "keyed")
    best = keyed.groupBy("part").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "id", "id2")).alias("best"))
    keyed = keyed.join(best, "part").withColumn(
        "keep", F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("id") == F.col("best.id")) & (F.col("id2") == F.col("best.id2"))
    )
    decided = keyed.groupBy("doc", "id", "id2").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))
    decided = stored(decided.where("not keep or n > 1"), "decided")
    # a row whose set no decision is about stays without a shuffle: only the others are joined
    asked = bit_array(decided, "id")
    fields = ", ".join(
        [f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(documents.schema)] + [f"{n} long" for n in _NUMBERS]
    )
    at = documents.columns.index(text)
    sure = documents.mapInArrow(_sets(width, at, False, asked, False), fields)
    marked = documents.mapInArrow(_sets(width, at, False, asked, True), fields)
    own = F.col(f"c{documents.columns.index(doc_id)}")
    same = own.eqNullSafe(decided["doc"]) & (marked["id"] == decided["id"]) & (marked["id2"] == decided["id2"])
    joined = marked.join(decided, same, "left").select(marked["*"], F.coalesce("keep", F.lit(True)).alias("keep")).where("keep")
    order = Window.partitionBy(own, "id", "id2").orderBy(F.lit(1))
    kept = joined.withColumn("nth", F.row_number().over(order)).where("nth = 1").select(sure.columns)
    return sure.unionByName(kept).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)))
