"""Spark session helpers.

The library takes the session it is given and writes intermediate tables only
below the checkpoint folder that session names (``spark.checkpoint.dir``). Without
one, a local master gets a private temporary folder (tests, benchmark); on a
cluster every executor would write to its own disk, so that raises.

Checkpoints go when their frames are collected, if
``spark.cleaner.referenceTracking.cleanCheckpoints`` is on. Written scratch tables
stay below ``<checkpoint folder>/quarry`` until that folder's owner removes them
after the application (a folder of its own for each application makes that one step).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")


def build_session(master: str = "local[8]", app_name: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the benchmark.

    On a cluster the caller builds the session; these defaults only mirror what
    matters there: AQE on (coalesce + skew-join split), broadcast decided by the
    planner from measured sizes, UTC session time zone, no UI server.
    """
    cores = _cores_of(master)
    parts = shuffle_partitions or max(8, 2 * cores)
    b = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _cores_of(master: str) -> int:
    if master.startswith("local[") and master.endswith("]"):
        inner = master[6:-1]
        if inner.isdigit():
            return int(inner)
    return os.cpu_count() or 8


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only on a local master without any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry/{name}-{uuid.uuid4().hex[:12]}"


def input_signature(spark: SparkSession, paths: list[str]) -> tuple:
    """(path, bytes, newest change) of each table folder or file; caches use it as key."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            out.append((name, -1, -1))
            continue
        files = fs.listStatus(path)
        out.append((name, sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)))
    return tuple(out)


def together(*jobs: Callable[[], T]) -> list[T]:
    """Results of independent Spark jobs, submitted side by side so that small ones don't wait for each other.

    The first error is raised after all have ended.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = [pool.submit(job) for job in jobs]
    return [r.result() for r in running]
