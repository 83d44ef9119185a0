"""Session settings the package relies on, and where it may write."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles, splits skewed joins, and joins by hashing where
# every partition it has measured is below the size it aims for. UTC keeps the day of an
# instant the same everywhere. Recording the Python line of every column is switched off,
# as it doubles the time to build a plan.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Shuffles of a sync are laid out for parts of about this many bytes on disk as Parquet,
# which are some three times that when shuffled. Adaptive execution joins parts that turn
# out small. Every map task keeps a size for each part, so a cluster may set a bound on
# their number in ``MOST_PARTS``; there is none otherwise.
PART_BYTES = 32 * 1024 * 1024
MOST_PARTS = "spark.daysync.mostShuffleParts"

_PARTITIONS = "spark.sql.shuffle.partitions"
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_own_folder: str | None = None


def builder(app: str) -> SparkSession.Builder:
    """A session builder with ``SETTINGS``; the caller adds master and sizes."""
    made = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made


def work_folder(spark: SparkSession) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) is it a temporary folder.
    """
    global _own_folder
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if _own_folder is None:
            _own_folder = tempfile.mkdtemp(prefix="daysync-")
        shared = _own_folder
    return f"{shared.rstrip('/')}/daysync-{uuid.uuid4().hex}"


@contextmanager
def shuffles_for(spark: SparkSession, size: int) -> Iterator[int]:
    """Inside, shuffles start with enough parts for ``size`` bytes, or what is set if more.

    Adaptive execution splits only parts that stand out, not a number that is too low.
    """
    setting = _PARTITIONS if spark.conf.get(_FIRST_PARTITIONS, None) is None else _FIRST_PARTITIONS
    kept = spark.conf.get(setting)
    wanted, most = -(-size // PART_BYTES), spark.conf.get(MOST_PARTS, None)
    parts = max(int(kept), wanted if most is None else min(int(most), wanted))
    spark.conf.set(setting, parts)
    try:
        yield parts
    finally:
        spark.conf.set(setting, kept)
