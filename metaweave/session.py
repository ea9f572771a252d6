"""Session defaults and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  They are applied only when
# the builder creates a new session; an existing (cluster) session keeps its
# own values.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A table may own a third of all DESCRIBE rows: let AQE split a skewed join
    # partition even when the following aggregate then needs its own shuffle
    # (on all of its keys, e.g. table + row block), instead of keeping the hot
    # table in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "metaweave",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local runs, tests) a fresh
    temporary folder is registered as the checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = tempfile.mkdtemp(prefix="metaweave-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/metaweave/{name}-{uuid.uuid4().hex}"


#: Lets Spark remove a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Around a write: nothing reads its shuffle files again, so they go with it and the disk holds those of one write at a time."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint root and read it back.

    Used at the pipeline's hand-off points (records -> graph -> search): it cuts
    the lineage, so a lost executor recomputes from the written files rather
    than from the raw tables, downstream branches read the result once instead
    of re-running the plan, and later scans get file statistics and column
    pruning.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
