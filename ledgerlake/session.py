"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill
in what is unset, so local runs and tests behave like the cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, AQE for runtime re-planning
# (coalescing, skew splits, broadcast conversion), no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Codec of stored tables. Row ids and change hashes are hexadecimal text: zstd halves it, snappy leaves it as long as it is.
CODEC = "zstd"

JIT_OPTIONS = os.environ.get("LEDGERLAKE_JIT_OPTIONS", "-XX:-DontCompileHugeMethods")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake") -> SparkSession:
    """Local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "8g"))
        # One machine: smaller target partitions keep all local cores busy.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        # Whole-stage codegen inlines wide expressions (the 56-field change
        # hash, 71-field version rows) into one method; HotSpot does not JIT
        # methods over 8000 bytecodes unless told to. On a cluster set the
        # same flag in spark.executor.extraJavaOptions.
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: With this a job's shuffle files go as soon as the job is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """``wanted`` settings for the jobs that start inside; those of before come back."""
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; only when it is unset (local
    tests) a fresh folder is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return f"{shared_dir(spark)}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"
