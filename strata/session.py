"""Session helpers: a local session for tests and benchmarks, and the shared
scratch location every job that cuts lineage or stages files must use."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """Single-JVM session for tests and benchmarks (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Wide cleaning projections generate methods above HotSpot's 8000-byte
        # JIT limit; without this flag they run interpreted (several times slower).
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    It is set by the deployment and is read, never replaced.  Where it is
    unset, a local master (tests, a laptop) gets a fresh local folder; any
    other master is refused, because executors would each write to their own
    disk.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def run_sql(spark: SparkSession, statement: str, limit: int | None = None, **values) -> DataFrame:
    """A statement with named parameters (``:name``), its result cut to ``limit`` rows if given."""
    result = spark.sql(statement, args=values) if values else spark.sql(statement)
    return result if limit is None else result.limit(limit)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application, where it is not installed there."""
    context = spark.sparkContext
    if any(name.rpartition("/")[2].startswith("strata-package-") for name in context.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="strata-"), f"strata-package-{uuid.uuid4().hex[:8]}")
    context.addPyFile(shutil.make_archive(base, "zip", root, "strata"))
