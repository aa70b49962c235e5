"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

A text is alone as soon as one of the three tells it from all others, and only texts that
length and prefix leave together have their whole content hashed. What one step hands to
the next is a bit per key in a table of at most ``2 ** (BITS - 6)`` rows, which is
broadcast; a bit set by another key lets a text through to the next step, never out of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.llm.shared import fresh, stored

#: Characters that the prefix hash reads.
PREFIX = 256
#: log2 of the bits that one step hands to the next: 2**18 rows of 64 bits.
BITS = 24
#: Groups with at least one in so many rows are broadcast; there can be no more of them than this.
HOT = 4096


def _marks(keys: DataFrame, key: Column) -> DataFrame:
    """``place, marks``: the bits of the 64-bit keys."""
    return keys.select(key.alias("key")).select(
        F.expr(f"shiftrightunsigned(key, {64 - BITS + 6})").alias("place"),
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITS}) & 63 as int))").alias("mark"),
    ).groupBy("place").agg(F.bit_or("mark").alias("marks"))


def _passed(rows: DataFrame, key: str, marks: DataFrame, flag: str) -> DataFrame:
    """``rows`` with whether the bit of their 64-bit ``key`` is set."""
    place = F.expr(f"shiftrightunsigned(`{key}`, {64 - BITS + 6})")
    mark = F.expr(f"coalesce(shiftrightunsigned(marks, cast(shiftrightunsigned(`{key}`, {64 - BITS}) & 63 as int)) & 1, 0) = 1")
    return rows.withColumn("place", place).join(F.broadcast(marks), "place", "left").withColumn(flag, mark).drop("place", "marks")


def with_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` left-joined to their ``groups`` by ``key``, which is never null.

    A group that holds one in ``HOT`` of ``total`` rows would make one task's partition large:
    such groups, at most ``HOT``, are broadcast. The others meet their rows in a shuffle. Both
    inputs are read twice, so they come from storage.
    """
    hot = F.col(size) * HOT >= total
    near = rows.join(F.broadcast(groups.where(hot)), key, "left")
    rest = near.where(F.col(size).isNull()).select(*rows.columns)
    return near.where(F.col(size).isNotNull()).unionByName(rest.join(groups.where(~hot), key, "left"))


def _hashed(documents: DataFrame, text: str, prefix: int) -> DataFrame:
    """``documents`` with ``full``: the whole content's hash where length and prefix are shared, else null."""
    value = F.coalesce(F.col(text), F.lit(""))
    length, head = F.octet_length(value), F.xxhash64(F.substring(value, 1, prefix))
    shapes = stored(documents.select(length.alias("length"), head.alias("head")), "shapes")
    lengths = shapes.groupBy("length").count().where("count > 1")
    shared = _passed(shapes.withColumn("key", F.xxhash64("length")), "key", _marks(lengths, F.xxhash64("length")), "shared")
    heads = shared.where("shared").groupBy("length", "head").count().where("count > 1")
    own, flag = fresh("key", documents.columns), fresh("shared", documents.columns)
    rows = documents.withColumn(own, F.xxhash64(length, head))
    rows = _passed(rows, own, _marks(heads, F.xxhash64("length", "head")), flag)
    return rows.withColumn("full", F.when(F.col(flag), F.sha2(value, 256))).drop(own, flag)


def classes(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", columns: Sequence[str] = (), prefix: int = PREFIX,
) -> DataFrame:
    """``doc_id, *columns, keep_id, group_size, kept``: every row with its group of equal texts.

    Texts are equal if all their bytes are; null counts as empty, and so do all empty texts
    as one group. Of a group the row with the largest ``doc_id`` stays (null is the smallest);
    of several rows with that id any one stays, exactly one. ``keep_id`` is null if all ids of
    the group are. Repeated ids and repeated rows are rows of their own. ``columns`` are
    carried along under their own names and may not be called ``keep_id``, ``group_size`` or
    ``kept``; other columns are not read. An empty table gives an empty result. Texts are read
    twice and never shuffled; a group of any size is combined before the shuffle.
    """
    # names of its own, so that no name of the caller's clashes with those used here
    inner = [f"c{i}" for i in range(len(columns))]
    narrow = documents.select(
        F.col(text).alias("text"), F.col(doc_id).alias("id"), *[F.col(c).alias(i) for c, i in zip(columns, inner)]
    )
    rows = stored(
        _hashed(narrow, "text", prefix).select("id", *inner, "full", F.monotonically_increasing_id().alias("tag")), "hashed"
    )
    groups = stored(
        rows.where("full IS NOT NULL").groupBy("full")
        .agg(F.count("*").alias("size"), F.max(F.struct("id", "tag")).alias("best")).where("size > 1"), "groups",
    )
    apart = rows.where("full IS NULL").withColumns({"size": F.lit(None).cast("long"), "best": F.lit(None).cast(groups.schema["best"].dataType)})
    found = with_groups(rows.where("full IS NOT NULL"), groups, "full", "size", rows.count()).unionByName(apart)
    alone = F.col("size").isNull()
    return found.select(
        F.col("id").alias(doc_id), *[F.col(i).alias(c) for c, i in zip(columns, inner)],
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("tag") == F.col("best.tag"))).alias("kept"),
    )


def drop_copies(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", prefix: int = PREFIX) -> DataFrame:
    """``documents`` with one row of each group of equal texts, whole and with all columns.

    The row with the largest ``doc_id`` stays, of several the one whose JSON has the largest
    digest, so that a repeated run keeps the same. Null texts count as empty. Rows whose length or
    prefix is theirs alone pass without a shuffle; of the others each task sends on one row a group.
    """
    own = {c: F.col(f"`{c}`") for c in documents.columns}
    rows = documents.select(F.struct(*own.values()).alias("row"), own[text].alias("text"), own[doc_id].alias("id"))
    rows = _hashed(rows, "text", prefix)
    order = F.struct("id", F.md5(F.to_json("row")))
    several = rows.where("full IS NOT NULL").groupBy("full").agg(F.max_by("row", order).alias("row"))
    return rows.where("full IS NULL").select("row.*").unionByName(several.select("row.*"))
