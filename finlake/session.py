"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that suit every size of input: plans are sized from observed shuffle bytes, and skewed join partitions
# are split even when that costs one more exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def get_session(app: str = "finlake", master: str | None = None, **extra: str) -> SparkSession:
    """The active session, or a new one. Without ``master`` the launcher (spark-submit) decides."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache
def _local_scratch() -> str:
    """One machine-local folder per process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="finlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    A folder set by ``SparkContext.setCheckpointDir`` counts as well. A machine-local one is used only where both are absent
    and the session itself is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/finlake-{purpose}-{uuid.uuid4().hex}"


# One shuffle partition per this many bytes of input. Run-time coalescing merges the small ones, so too many cost little
# and too few spill.
BYTES_PER_PARTITION = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def shuffles_sized_for(
    spark: SparkSession, input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION
) -> Iterator[int]:
    """Exchanges planned inside start with enough partitions for the input; never fewer than the session's own."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    configured = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(configured, input_bytes // bytes_per_partition)
    if wanted == configured:
        yield configured
        return
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


#: Jobs that one run submits side by side, so that the last tasks of one leave no core idle.
JOBS_AT_ONCE = 4


def at_once(job: Callable, items: Iterable) -> list:
    """What ``job`` gives for each item, in their order, in the caller's job group; settings of the session must not change inside."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(job), item) for item in items]]


@contextmanager
def unsorted_writes(spark: SparkSession, open_files: int) -> Iterator[None]:
    """Writes inside may keep up to ``open_files`` files of a task open instead of sorting its rows by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(open_files))
    try:
        yield
    finally:
        spark.conf.set(key, before)
