"""Session defaults and the shared scratch location."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F


def session(app_name: str = "burstwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    The zone must be UTC: window bounds are formatted and naive times are read
    in the session zone. Cluster sizing (shuffle partitions, memory) is left to
    spark-submit; adaptive execution picks reducer counts and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Window state of many pages outgrows the heap; RocksDB keeps it on disk.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Checkpoint files go once nothing refers to them, also in long-running streams.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, whose Python workers run the forest and the search.

    Once per application; like ``--py-files``, it goes through Spark's file server.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="burstwatch-")) / package.name), "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location of the session.

    Without ``spark.checkpoint.dir`` only a local master may fall back to a
    temporary folder; executors of a cluster could not see one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="burstwatch-")
    return f"{root.rstrip('/')}/burstwatch/{name}-{uuid.uuid4().hex}"


def cut_lineage(rows: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(rows.sparkSession, "checkpoints"))
    return rows.checkpoint()


# Rows of a few keys each; a million of them are some tens of megabytes.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if a count shows at most ``limit`` rows, else the rows as they are.

    The count reads the rows, so give it a checkpoint or a file-backed table.
    Beyond the limit the join shuffles, and adaptive execution splits hot keys.
    """
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def spread(rows: DataFrame) -> DataFrame:
    """Spread an input of fewer partitions than cores, as from one small file.

    Inputs that already occupy the cluster come back unchanged, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
