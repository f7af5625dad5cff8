"""Session builder and the shared scratch location."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "merchlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on. ``master`` stays unset under spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        # One time zone for every parse and every calendar key.
        .config("spark.sql.session.timeZone", "Asia/Shanghai")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A hot product or order key is split even where that costs one more exchange.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Row numbering leaves small checkpoints behind; drop them with their frames.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def split_shuffles(spark: SparkSession, path: str, part_mb: int = 4) -> None:
    """Let shuffles begin with a partition for every ``part_mb`` of the files under ``path`` where that
    is more than the session has, so that what one task sorts or folds does not grow with the input.
    Adaptive execution merges the small ones."""
    wanted = int(folder_bytes(spark, path) / (part_mb * 1_000_000))
    if wanted > int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = threading.Lock()
# Per session: writes under way, and the setting before the first of them.
_writes: dict[int, tuple[int, str | None]] = {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is run inside deletes its shuffle files when it ends. They would otherwise stay until the
    driver happens to collect its garbage. For writes, whose plans nothing runs again."""
    key = spark._jsparkSession.hashCode()
    with _freeing:
        under_way, before = _writes.get(key) or (0, spark.conf.get(FREE_SHUFFLES, None))
        _writes[key] = under_way + 1, before
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing:
            under_way, before = _writes.pop(key)
            if under_way > 1:
                _writes[key] = under_way - 1, before
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def folder_bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that they share all folders."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate data: the one the cluster names in ``spark.checkpoint.dir``.

    A local session without one uses a folder under its warehouse. Elsewhere there is no safe
    choice: on a cluster each executor would write to its own disk, and reads would miss parts.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not _local(spark):
        raise ValueError(f"name a folder that all executors share in {CHECKPOINT_KEY}")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder where the context has none yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table in the shared folder. All of an application's scratch
    tables are deleted when it ends."""
    root = f"{shared_root(spark)}/scratch-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return f"{root}/{label}-{uuid.uuid4().hex}"
