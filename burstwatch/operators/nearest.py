"""Exact nearest-article search: best cosine inside a time interval.

Comparing every flagged page with every article of the last day would be a
cross join. The search instead

1. cuts time into buckets, so that an anomaly meets only the buckets its
   interval touches;
2. splits the articles of a bucket around pivots drawn from them, and each part
   again, until a part holds a bounded number of articles. The angle to a part's pivot
   bounds the similarity to everything in the part (triangle inequality on the
   sphere), and a part inside another cannot beat the outer bound. Each anomaly first
   goes down to its most promising leaf; the best similarity found there then
   decides which other parts it has to enter. Nothing is approximated: a part is skipped
   only when it cannot hold a better article;
3. cuts leaves and their visitors into blocks of bounded size. A block is one
   matrix product and returns one row per anomaly, never the pairs.

How deep the tree of a bucket is follows from its articles alone; a bucket that fits
one leaf is its own root. Pivots stay in tables and meet articles and anomalies in
blocks as well, so nothing that grows with the data reaches the driver or every task. Which
side of a join is broadcast is never left to estimates: they take a vector for a single number.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from burstwatch.operators.ranking import ranked
from burstwatch.session import BROADCAST_ROWS, cut_lineage

# Fixed value: how long an article stays matchable.
RETENTION = timedelta(hours=24)

# After every instant there is.
FOREVER = 2**63 - 1

# An interval covers this many buckets, give or take one.
BUCKETS_PER_INTERVAL = 4
# Rows per block, and per leaf; 16384 vectors of 384 doubles are 50 MB.
ARTICLE_BLOCK = 16_384
ANOMALY_BLOCK = 4_096
# Parts that one is split into.
FANOUT = 16
# Bounds are loosened by this much, so that rounding of an angle never skips a
# part that could hold the best article.
SLACK = 1e-6
TILE = 512

BLOCK = ["node", "asked_block", "listed_block"]
# Behind the name of a part whose articles all point one way: it cannot be split.
SAME = "="


def nearest_news(
    anomalies: DataFrame,
    news: DataFrame,
    retention: timedelta = RETENTION,
    vector: str = "embedding",
    at: str = "handled_at",
    added: str = "added_at",
    key: str = "event_id",
    article_block: int = ARTICLE_BLOCK,
    anomaly_block: int = ANOMALY_BLOCK,
    materialize: bool = True,
    fanout: int = FANOUT,
) -> DataFrame:
    """Each anomaly with its most similar article of the retention interval.

    An article is a candidate when it was added at or before the anomaly was
    handled and is not older than ``retention``. Adds ``similarity_score`` and
    ``article`` (the article's other columns as a struct), both null without a
    candidate. Equal similarities go to the smaller key.

    Of an article that was added again, only the latest row by the time an anomaly
    was handled is a candidate, and one of those added at the same time. Articles
    without a key are articles of their own.

    Anomalies are told apart by hashes of vector and time: equal ones have
    equal answers, and the hashes are the same when a lost task is run again.
    Both inputs are read several times and therefore checkpointed; pass
    ``materialize=False`` for tables that are cheap to read again.
    """
    if materialize:
        anomalies, news = cut_lineage(anomalies), cut_lineage(news)
    keep = micros(retention)
    width = keep // BUCKETS_PER_INTERVAL
    asked = anomalies.withColumn("q_id", F.concat_ws(":", F.xxhash64(vector, at), F.xxhash64(at, F.lit(1), vector)))
    queries = (
        asked.filter(F.col(vector).isNotNull() & F.col(at).isNotNull())
        .select("q_id", F.col(vector).alias("v"), F.unix_micros(at).alias("t"))
        .dropDuplicates(["q_id"])
    )
    others = [c for c in news.columns if c != vector]
    # what an article says, without its vector, which only a hash stands for
    row = F.md5(F.concat_ws(":", F.to_json(F.struct(*others)), F.xxhash64(vector)))
    listed = news.filter(F.col(vector).isNotNull() & F.col(added).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), row).alias("key"),
        row.alias("row"),
        F.col(vector).alias("v"),
        F.unix_micros(added).alias("t"),
    )
    # A row counts until the next one of its key; of one instant the first by content counts.
    following = Window.partitionBy("key").orderBy("t", F.desc("row"))
    articles = listed.withColumn("until", F.coalesce(F.lead("t").over(following), F.lit(FOREVER))).filter(
        "until > t"
    ).withColumn("node", F.floor(F.col("t") / width).cast("string"))
    # The bucket of each bound is worked out the same way as the articles' own.
    touched = F.sequence(F.floor((F.col("t") - keep) / width), F.floor(F.col("t") / width))
    roots = queries.withColumn("node", F.explode(F.transform(touched, lambda b: b.cast("string"))))

    placed, levels, nodes = _tree(articles, article_block, fanout)
    search = _Search(keep, article_block, anomaly_block, nodes)
    if levels:
        # what the most promising leaf holds decides which others have to be looked at
        roots = roots.join(articles.select("node").distinct(), "node", "left_semi")
        probes = _leaves(roots, levels, search, None)
        probed = cut_lineage(search.best(probes, placed))
        floor = probed.groupBy("q_id").agg(F.max("score").alias("floor"))
        rest = _leaves(roots, levels, search, floor).join(probes.select("q_id", "node"), ["q_id", "node"], "left_anti")
        best = probed.unionByName(search.best(rest, placed))
    else:
        best = search.best(roots, placed)

    winner = (
        best.groupBy("q_id")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "key", "row")).alias("w"))
        .select("q_id", (-F.col("w.s")).alias("similarity_score"), "w.row")
    )
    payload = news.select(row.alias("row"), F.struct(*others).alias("article"))
    wanted = payload.join(winner.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"])
    found = winner.join(wanted, "row").drop("row")
    return asked.join(found, "q_id", "left").drop("q_id")


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _tree(articles: DataFrame, size: int, fanout: int) -> tuple[DataFrame, list[DataFrame], int]:
    """The articles with their leaf as ``node``, per level the parts of the nodes split there, and how many leaves there are.

    A level's rows are ``node, child, v, near, far``: the pivot of a part and the least and largest
    angle of its articles to it. Pivots are articles with different vectors, the smallest by hash, so
    that every part is smaller than what it was split from, unless all vectors point one way.
    """
    placed, levels = articles, []
    kind = articles.schema["v"].dataType.simpleString()
    while True:
        sizes = placed.groupBy("node").agg(F.count("*").alias("n"))
        too_large = (F.col("n") > size) & ~F.col("node").endswith(SAME)
        nodes, split = sizes.agg(F.count("*"), F.count_if(too_large)).first()
        if not split:
            return placed, levels, nodes
        crowded = cut_lineage(sizes.filter(too_large).select("node"))
        inside = placed.join(crowded, "node", "left_semi")
        vectors = inside.withColumn("hash", F.xxhash64("v")).groupBy("node", "hash").agg(F.first("v").alias("v"))
        pivots = cut_lineage(ranked(vectors, ["node"], [F.col("hash")], fanout).select(
            "node", F.concat_ws(".", "node", F.col("rank").cast("string")).alias("child"), "v"
        ))
        moved = cut_lineage(_meet(
            inside, "row", size, pivots, "child", fanout, nodes, _nearest_pivot,
            f"key string, row string, v {kind}, t bigint, until bigint, child string, angle double, parent string",
        ))
        spans = moved.groupBy("parent", "child").agg(F.min("angle").alias("near"), F.max("angle").alias("far"))
        # a part that holds all of its parent's articles, which then all point one way
        parts = spans.groupBy("parent").agg(F.count("*").alias("parts"))
        name = F.when(F.col("parts") == 1, F.concat("child", F.lit(SAME))).otherwise(F.col("child"))
        named = cut_lineage(spans.join(parts, "parent").join(pivots.select("child", "v").hint("merge"), "child").select(
            F.col("parent").alias("node"), "child", name.alias("name"), "v", "near", "far"
        ))
        levels.append(named.select("node", F.col("name").alias("child"), "v", "near", "far"))
        moved = moved.join(named.select("child", F.col("name").alias("node")), "child")
        kept = placed.join(crowded, "node", "left_anti").select("key", "row", "v", "t", "until", "node")
        placed = cut_lineage(kept.unionByName(moved.select(*kept.columns)))


def _leaves(roots: DataFrame, levels: list[DataFrame], search: "_Search", floor: DataFrame | None) -> DataFrame:
    """``q_id, v, t, node``: the leaves an anomaly may find something better than ``floor`` in.

    Without ``floor`` only the most promising one: at each level the part with the nearest pivot.
    """
    queries = roots.select("q_id", "v", "t").dropDuplicates(["q_id"]).hint("merge")
    reached = roots.select("q_id", "node", F.lit(1.0).alias("bound"))
    for level in levels:
        inner = level.select("node").distinct()
        asked = reached.join(inner, "node", "left_semi").join(queries, "q_id")
        below = _meet(
            asked, "q_id", search.anomaly_block, level, "child", FANOUT, search.nodes, _bounds,
            "q_id string, node string, bound double, angle double",
        )
        reached = reached.join(inner, "node", "left_anti").unionByName(below, allowMissingColumns=True)
        if floor is None:
            # the nearest pivot; an undivided bucket has none to go by
            best = F.min(F.struct(F.coalesce("angle", F.lit(4.0)).alias("angle"), "node", "bound")).alias("b")
            reached = reached.groupBy("q_id").agg(best).select("q_id", "b.node", "b.bound")
        else:
            reached = reached.join(floor, "q_id", "left").filter(
                F.col("bound") + SLACK >= F.coalesce("floor", F.lit(-1.0))
            ).select("q_id", "node", "bound")
        reached = cut_lineage(reached)
    return reached.join(queries, "q_id").select("q_id", "v", "t", "node")


def _meet(
    asked: DataFrame, asked_id: str, asked_size: int, listed: DataFrame, listed_id: str, listed_size: int, nodes: int,
    match: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """``match`` of every block of ``asked`` with every block of ``listed`` in the same node.

    How many blocks a node is cut into comes from its sizes, one row per node; a node with a
    third of all rows becomes many blocks on many executors. The sizes are broadcast unless there
    are too many ``nodes``; the rows never are.
    """
    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy("node").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    def dealt(rows: DataFrame, key: str, own: str, other: str) -> DataFrame:
        at = F.pmod(F.xxhash64(key), F.col(f"n_{own}")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)).alias(other)
        # aliased, as both sides may come from the same rows
        return rows.join(shape, "node").select(*[F.col(c).alias(c) for c in rows.columns], at, every)

    shape = blocks(asked, asked_size, "n_asked_block").join(blocks(listed, listed_size, "n_listed_block"), "node")
    shape = shape.hint("broadcast" if nodes <= BROADCAST_ROWS else "merge")
    left = dealt(asked, asked_id, "asked_block", "listed_block")
    right = dealt(listed, listed_id, "listed_block", "asked_block")
    return left.groupBy(*BLOCK).cogroup(right.groupBy(*BLOCK)).applyInArrow(match, schema)


class _Search:
    """Best article per (anomaly, block) for anomalies sent to leaves."""

    def __init__(self, keep: int, article_block: int, anomaly_block: int, nodes: int):
        self.keep, self.article_block, self.anomaly_block, self.nodes = keep, article_block, anomaly_block, nodes

    def best(self, visits: DataFrame, articles: DataFrame) -> DataFrame:
        """Rows ``q_id, score, key, row``: one per anomaly and article block with a candidate."""
        keep = self.keep

        def match(asked: pa.Table, listed: pa.Table) -> pa.Table:
            return _best_in_block(asked, listed, keep)

        return _meet(
            visits, "q_id", self.anomaly_block, articles, "row", self.article_block, self.nodes, match,
            "q_id string, score double, key string, row string",
        )


def _angles(asked: pa.Table, pivots: pa.Table) -> np.ndarray:
    """Angles of each vector to every pivot; a zero vector is put at a right angle."""
    cosines = _unit(_matrix(asked)) @ _unit(_matrix(pivots)).T
    return np.arccos(np.clip(np.nan_to_num(cosines), -1.0, 1.0))


def _nearest_pivot(articles: pa.Table, pivots: pa.Table) -> pa.Table:
    pivots = pivots.sort_by("child")
    angles = _angles(articles, pivots)
    nearest = angles.argmin(axis=1)
    return pa.table({
        **{c: articles[c] for c in ("key", "row", "v", "t", "until")},
        "child": pivots["child"].take(pa.array(nearest)),
        "angle": pa.array(angles[np.arange(len(nearest)), nearest]),
        "parent": articles["node"],
    })


def _bounds(asked: pa.Table, parts: pa.Table) -> pa.Table:
    """The largest similarity each anomaly may find in each part."""
    near, far = parts["near"].to_numpy(), parts["far"].to_numpy()
    angles = _angles(asked, parts)
    gaps = np.maximum(0.0, np.maximum(angles - far, near - angles))
    bounds = np.minimum(np.cos(gaps), asked["bound"].to_numpy()[:, None])
    k = len(parts)
    return pa.table({
        "q_id": asked["q_id"].take(pa.array(np.repeat(np.arange(len(asked)), k))),
        "node": parts["child"].take(pa.array(np.tile(np.arange(k), len(asked)))),
        "bound": pa.array(bounds.ravel()),
        "angle": pa.array(angles.ravel()),
    })


def _best_in_block(asked: pa.Table, listed: pa.Table, keep: int) -> pa.Table:
    # the first of equal maxima is then the smaller key
    listed = listed.sort_by([("key", "ascending"), ("row", "ascending")])
    q, q_t = _unit(_matrix(asked)), asked["t"].to_numpy()
    n, n_t, n_until = _unit(_matrix(listed)), listed["t"].to_numpy(), listed["until"].to_numpy()
    scores, rows = np.full(len(q), -np.inf), np.zeros(len(q), dtype=np.int64)
    if len(n):
        for start in range(0, len(q), TILE):
            tile = slice(start, start + TILE)
            similarity = q[tile] @ n.T
            t = q_t[tile, None]
            similarity[(n_t > t) | (n_until <= t) | (n_t < t - keep) | np.isnan(similarity)] = -np.inf
            rows[tile] = similarity.argmax(axis=1)
            scores[tile] = similarity.max(axis=1)
    hit = np.flatnonzero(scores > -np.inf)
    chosen = listed.take(pa.array(rows[hit]))
    return pa.table({
        "q_id": asked["q_id"].take(pa.array(hit)),
        "score": pa.array(scores[hit]),
        "key": chosen["key"],
        "row": chosen["row"],
    })


def _matrix(table: pa.Table) -> np.ndarray:
    vectors = table["v"].combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.empty((0, 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN and matches nothing."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
