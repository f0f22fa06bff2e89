"""The ledgers of loads: which loads ran, which files they brought, which periods are closed.

A load writes ``started`` before it writes a row and ``finished`` with its
counters after the last; one that fails on the way writes ``failed``.  Rows of a batch count
once its files are in the file ledger.  A batch is cleared only by its own
record: when its load failed, or when it started longer ago than a load can
take.  Batches that have no record here, and loads that still run, are never
touched.

Every batch writes its ledger rows in its own partition, so that loads may run side by side.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import tables
from strata.plans.tables import Storage

STARTED, FAILED, CLEARED, FINISHED = "started", "failed", "cleared", "finished"

LOADS = "state string, at timestamp, n_files long, n_rows long, n_malformed long"


def record(spark: SparkSession, loads: str, batch_id: str, state: str, storage: Storage, files=None, rows=None, malformed=None) -> None:
    """Note what a load has come to."""
    row = (state, _dt.datetime.now(_dt.timezone.utc), files, rows, malformed)
    noted = spark.createDataFrame([row], LOADS).withColumn("_batch_id", F.lit(batch_id))
    tables.append(noted, loads, ["_batch_id"], storage, {"_batch_id": batch_id})


def batches(spark: SparkSession, loads: str) -> DataFrame:
    """``_batch_id, started_at, state, at, n_files, n_rows, n_malformed``: what each load has come to last."""
    last = F.max_by(F.struct("state", "at", "n_files", "n_rows", "n_malformed"), F.struct("at", F.col("state") != STARTED))
    grouped = spark.table(loads).groupBy("_batch_id").agg(F.min("at").alias("started_at"), last.alias("last"))
    return grouped.select("_batch_id", "started_at", "last.*")


def clear_unfinished(spark: SparkSession, loads: str, bronze: list[str], storage: Storage, stale_after: _dt.timedelta) -> list[str]:
    """Drop the batches of loads that failed, or that started before ``stale_after`` and never ended."""
    if not tables.table_exists(spark, loads):
        return []
    since = F.lit(_dt.datetime.now(_dt.timezone.utc) - stale_after)
    dead = (F.col("state") == FAILED) | ((F.col("state") == STARTED) & (F.col("at") < since))
    found = [r["_batch_id"] for r in batches(spark, loads).where(dead).collect()]  # loads gone wrong since the last one
    for batch in found:
        for name in bronze:
            if tables.table_exists(spark, name):
                tables.clear_partition(spark, name, {"_batch_id": batch}, storage)
        record(spark, loads, batch, CLEARED, storage)
    return found


def latest_finished(spark: SparkSession, loads: str) -> str | None:
    """The batch that was finished last."""
    found = batches(spark, loads).where(F.col("state") == FINISHED).agg(F.max(F.struct("at", "_batch_id")).alias("last")).first()["last"]
    return found["_batch_id"] if found else None


def audit(spark: SparkSession, loads: str, k: int = 10) -> DataFrame:
    """Rows and files of the newest ``k`` batches as counted when they were written; no data is read."""
    finished = batches(spark, loads).where(F.col("state") == FINISHED)
    counts = finished.select("_batch_id", F.col("n_rows").alias("registros"), F.col("n_files").alias("arquivos"))
    return counts.orderBy(F.col("_batch_id").desc()).limit(k)


def close_periods(spark: SparkSession, closed: str, periods: list[str], storage: Storage) -> None:
    """Later loads do not look into the folders of these periods, unless they are asked to."""
    rows = spark.createDataFrame([(p,) for p in periods], "period string")
    if tables.table_exists(spark, closed):
        rows = rows.join(spark.table(closed), "period", "left_anti")
    tables.append(rows, closed, None, storage)


def closed_periods(spark: SparkSession, closed: str) -> set[str]:
    if not tables.table_exists(spark, closed):
        return set()
    return {r["period"] for r in spark.table(closed).select("period").distinct().collect()}  # one a month
