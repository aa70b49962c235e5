"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Training draws each tree's sample from all rows and grows every tree in its own
group; scoring sends Arrow batches through the grown trees. The trees are the
only thing that is shipped to every task: at most ``trees * (2 * sample - 1)``
nodes, whatever the size of the data.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from burstwatch.operators.quantiles import exact_quantiles
from burstwatch.operators.ranking import ranked
from burstwatch.schemas import FEATURES

# Default model settings and where a model is looked for.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.01
SEED = 42
MODEL_PATH_VARIABLE = "ANOMALY_MODEL_PATH"
DEFAULT_MODEL_PATH = "models/anomaly_detector"

# Thinning keeps this many times the sample per tree, so that the exact cut to
# the sample size practically never runs short.
THINNING = 4
# Equal rows are counted once and told apart by number, in runs of this length.
RUN = 4096
EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, path double"
)


def _average_path(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _chance(seed: int, tree: int, place: int) -> tuple[int, float]:
    """A whole number to pick a feature with and a uniform one to split it, from the digest of a node's place."""
    digest = hashlib.md5(f"{seed}:{tree}:{place}".encode()).hexdigest()
    return int(digest[:8], 16), int(digest[8:16], 16) / 2**32


def _grow(points: np.ndarray, height: int, seed: int, tree: int) -> list[tuple]:
    """Nodes ``(feature, threshold, left, path)`` of one random tree, breadth first.

    The right child follows the left one; a leaf has feature -1 and holds the path length.
    A node's place is 1 at the root, and twice its parent's (plus 1 on the right) below.
    The order of the points plays no part.
    """
    nodes: list[tuple] = []
    queue = [(np.arange(len(points)), 0, 1)]
    while len(nodes) < len(queue):
        members, depth, place = queue[len(nodes)]
        block = points[members]
        low, high = block.min(axis=0), block.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= height or len(splittable) == 0:
            nodes.append((-1, 0.0, -1, depth + _average_path(len(members))))
            continue
        pick, share = _chance(seed, tree, place)
        feature = int(splittable[pick % len(splittable)])
        threshold = float(low[feature] + share * (high[feature] - low[feature]))
        if threshold >= high[feature]:
            threshold = float(low[feature])
        goes_left = block[:, feature] <= threshold
        children = len(queue)
        queue.append((members[goes_left], depth + 1, 2 * place))
        queue.append((members[~goes_left], depth + 1, 2 * place + 1))
        nodes.append((feature, threshold, children, 0.0))
    return nodes


@dataclass
class IsolationForest:
    """A fitted forest: node rows, the sample size they were grown on, and the cut-off."""

    nodes: pd.DataFrame
    sample: int
    offset: float
    contamination: float = CONTAMINATION
    seed: int = SEED

    @classmethod
    def fit(
        cls,
        rows: DataFrame,
        trees: int = TREES,
        sample: int = SAMPLE,
        contamination: float = CONTAMINATION,
        seed: int = SEED,
    ) -> "IsolationForest":
        """Grow ``trees`` on ``sample`` rows each and set the cut-off.

        Rows are picked per tree by a hash of their content and their number among
        equal rows, so the result does not depend on partitioning and a row that
        makes up a share of the data makes up that share of each sample. The cut-off is the ``contamination`` quantile
        of the training scores: that share of the training rows scores below 0.
        """
        data = rows.select(*_inputs()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            count = data.count()
            if count == 0:
                raise ValueError("no rows to train on")
            size = min(sample, count)
            grown = _grow_trees(data, count, trees, size, seed)
            nodes = grown.toPandas().sort_values(["tree", "node"], ignore_index=True)
            if nodes["tree"].nunique() != trees:
                raise RuntimeError(f"only {nodes['tree'].nunique()} of {trees} trees were grown")
            model = cls(nodes, size, 0.0, contamination, seed)
            scored = data.select(model.score_column().alias("score")).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                model.offset = exact_quantiles(scored, ["score"], [contamination])["score"][0]
            finally:
                scored.unpersist()
            return model
        finally:
            data.unpersist()

    def score_column(self) -> Column:
        """Score of a row's features: the forest's, shifted so that unusual rows are below 0."""
        forest, offset = _Arrays(self.nodes, self.sample), self.offset

        @F.pandas_udf("double")
        def decide(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for series in batches:
                points = np.column_stack([s.to_numpy(dtype=np.float64) for s in series])
                yield pd.Series(forest.score(points) - offset)

        return decide(*_inputs())

    def score(self, rows: DataFrame, column: str = "anomaly_score") -> DataFrame:
        """Add the continuous score. Works on tables and streams."""
        return rows.withColumn(column, self.score_column())

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees as Parquet and the settings as JSON, through Spark's own file systems."""
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        settings = json.dumps({
            "sample": self.sample, "offset": self.offset,
            "contamination": self.contamination, "seed": self.seed, "features": FEATURES,
        })
        spark.createDataFrame([(settings,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str | None = None) -> "IsolationForest":
        location = resolve_model_path(path)
        try:
            settings = json.loads(spark.read.text(f"{location}/settings").first()["value"])
            nodes = spark.read.parquet(f"{location}/trees").toPandas()
        except AnalysisException as error:
            raise FileNotFoundError(f"Trained model not found at {location}.") from error
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        return cls(nodes, settings["sample"], settings["offset"], settings["contamination"], settings["seed"])


def resolve_model_path(path: str | None = None) -> str:
    """The given path, else the environment's, else the default."""
    return path or os.environ.get(MODEL_PATH_VARIABLE) or DEFAULT_MODEL_PATH


def _inputs() -> list[Column]:
    """The feature vector with missing values as 0."""
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]


def _content() -> Column:
    """Digest of a row's features: their whole parts and 40 bits of what is behind the point."""
    whole = [F.floor(c) for c in FEATURES]
    parts = [F.floor((F.col(c) - w) * F.lit(2.0**40)) for c, w in zip(FEATURES, whole)]
    return F.md5(F.concat_ws(":", *[x.cast("string") for pair in zip(whole, parts) for x in pair]))


def _grow_trees(data: DataFrame, count: int, trees: int, size: int, seed: int) -> DataFrame:
    """Node rows of every tree.

    Equal rows are counted first, and their copies numbered again in runs that are
    dealt over the tasks, so that a row that fills a third of the data is no hot key.
    Trees form as few groups as leave each tree ``THINNING * size`` rows, one group if there are
    rows for all. A digest of a copy and a group's number says which tree of the group it is offered to,
    and in which order; a tree takes the ``size`` first. So a copy has one digest a group and not
    one a tree. Later ones are dropped before the shuffle: about ``THINNING * size * trees`` rows are left.
    """
    groups = min(trees, math.ceil(THINNING * size * trees / count))
    counted = data.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("copies"))
    runs = counted.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / RUN))).alias("run"))
    first, last = F.col("run") * RUN, F.least("copies", (F.col("run") + 1) * RUN) - 1
    copies = runs.repartition(*FEATURES, "run").select(
        *FEATURES, _content().alias("content"), F.explode(F.sequence(first, last)).alias("copy")
    )
    offered = copies.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    key = F.md5(F.concat_ws(":", F.lit(seed), "content", F.col("copy").cast("string"), F.col("group").cast("string")))
    members = F.floor((F.lit(trees - 1) - F.col("group")) / F.lit(groups)) + 1  # trees of the group
    number = F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")
    drawn = offered.withColumn("number", number).withColumn("members", members).select(
        *FEATURES, "members", (F.col("group") + groups * F.pmod("number", "members")).cast("int").alias("tree"),
        F.expr("number div members").alias("draw"),
    )
    share = F.least(F.lit(1.0), F.lit(THINNING * size / count) * F.col("members"))
    drawn = drawn.filter(F.col("draw") <= share * F.lit(2.0**60) / F.col("members"))
    chosen = ranked(drawn, ["tree"], [F.col(c) for c in ("draw", *FEATURES)], size)
    height = max(1, math.ceil(math.log2(max(size, 2))))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        if len(group) < size:
            raise RuntimeError(f"tree {tree} drew {len(group)} of {size} rows")
        nodes = _grow(group[list(FEATURES)].to_numpy(dtype=np.float64), height, seed, tree)
        table = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "path"])
        table.insert(0, "node", np.arange(len(table)))
        table.insert(0, "tree", tree)
        return table

    return chosen.select("tree", *FEATURES).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


class _Arrays:
    """The forest as flat arrays, walked level by level for a block of rows at once.

    Children are neighbours, so the next node is ``left + (value > threshold)``;
    leaves point to themselves with a threshold nothing exceeds.
    """

    BLOCK = 512  # rows; a block's 100 trees then stay within the processor's cache

    def __init__(self, nodes: pd.DataFrame, sample: int):
        node, feature = nodes["node"].to_numpy(), nodes["feature"].to_numpy()
        own, leaf = np.arange(len(nodes)), feature < 0
        self.roots = np.flatnonzero(node == 0)
        self.feature = np.where(leaf, 0, feature).astype(np.intp)
        self.threshold = np.where(leaf, np.inf, nodes["threshold"].to_numpy())
        self.left = np.where(leaf, own, own - node + nodes["left"].to_numpy()).astype(np.intp)
        self.path = nodes["path"].to_numpy()
        self.height = max(1, math.ceil(math.log2(max(sample, 2))))
        self.scale = _average_path(sample) or 1.0

    def score(self, points: np.ndarray) -> np.ndarray:
        scores = np.empty(len(points))
        for start in range(0, len(points), self.BLOCK):
            block = points[start:start + self.BLOCK]
            values = block.ravel()
            first = (np.arange(len(block)) * points.shape[1])[:, None]
            at = np.broadcast_to(self.roots, (len(block), len(self.roots)))
            for _ in range(self.height):
                above = values.take(first + self.feature.take(at)) > self.threshold.take(at)
                at = self.left.take(at) + above
            depth = self.path.take(at).mean(axis=1)
            scores[start:start + self.BLOCK] = -np.exp2(-depth / self.scale)
        return scores
