"""Stage an intermediate result as Parquet in the shared checkpoint folder.

Used where several outputs consume one expensive intermediate (the cleaned
and classified silver rows feed five outputs) and as an optimizer boundary:
the rule filters over the classification column must not be pushed back
into, and re-inlined with, the cleaning projection.  Unlike an RDD
checkpoint, Parquet keeps column pruning and filter pushdown for the
consumers, and unlike a cache it survives the loss of an executor.

Work that ends before it returns, as a load does, stages within ``scratch``:
there staged results are managed tables of a namespace of their own, which is
dropped with their files when the work ends.  What a killed run left is
dropped by a later one.  Results that are still to be read when a function
returns are staged outside of it, and stay until the deployment cleans the folder.
"""

from __future__ import annotations

import datetime as _dt
import functools
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path

PREFIX = "strata_scratch_"
STAMP = "%Y%m%d%H%M%S"

#: Scratch namespaces older than this are left by runs that were killed.
SWEEP_AFTER = _dt.timedelta(days=2)

_NAMESPACE: ContextVar[str | None] = ContextVar("scratch", default=None)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


def sweep(spark: SparkSession, older_than: _dt.timedelta = SWEEP_AFTER) -> list[str]:
    """Drop the scratch namespaces of runs that never ended; their names tell when they began."""
    swept = []
    for database in spark.catalog.listDatabases(f"{PREFIX}*"):
        began = re.fullmatch(PREFIX + r"(\d{14})_\w+", database.name)
        if began and _now() - _dt.datetime.strptime(began[1] + "+0000", STAMP + "%z") > older_than:
            spark.sql(f"DROP DATABASE IF EXISTS {database.name} CASCADE")
            swept.append(database.name)
    return swept


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Within, ``stage`` writes tables that are dropped at the end; an inner scratch is the outer one."""
    if outer := _NAMESPACE.get():
        yield outer
        return
    sweep(spark)
    name = f"{PREFIX}{_now().strftime(STAMP)}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION :location", args={"location": scratch_path(spark, name)})
    token = _NAMESPACE.set(name)
    try:
        yield name
    finally:
        _NAMESPACE.reset(token)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def in_scratch(work: Callable) -> Callable:
    """``work(spark, …)``, which returns when all is done, with its staged results dropped at the end."""

    @functools.wraps(work)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch(spark):
            return work(spark, *args, **kwargs)

    return run


def stage_path(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` once under ``spark.checkpoint.dir``; return the folder."""
    path = scratch_path(df.sparkSession, name)
    _writer(df, partition_by).parquet(path)
    return path


def _writer(df: DataFrame, partition_by: list[str] | None):
    rows = df.hint("rebalance", *partition_by) if partition_by else df  # few files per folder
    writer = rows.write.mode("errorifexists")
    return writer.partitionBy(*partition_by) if partition_by else writer


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and return a scan of it."""
    if namespace := _NAMESPACE.get():
        table = f"{namespace}.{re.sub('[^a-z0-9]', '_', name.lower())}_{uuid.uuid4().hex[:8]}"
        _writer(df, partition_by).format("parquet").saveAsTable(table)
        return df.sparkSession.table(table)
    reader = df.sparkSession.read
    if partition_by:
        reader = reader.schema(df.schema)  # else the partition values' types are guessed
    return reader.parquet(stage_path(df, name, partition_by))
