"""Incremental bronze ingestion as a Structured Streaming file source.

The file source records the files of every epoch in the query's checkpoint.
An epoch is one bronze batch, named by the query and the epoch's number, and
writing it replaces its partition: an epoch that is repeated after a failure
leaves the rows of one run.

A streaming file source needs its columns beforehand.  Files whose header
differs from the given one are refused by the reader (``enforceSchema`` off),
never read by position; load such files with ``load_bronze``.

Stream and batch loads share the ledgers: an epoch notes its files and its
load like any other, leaves out files that another batch has brought, and no
load clears what it did not write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.names import normalize_column_name
from strata.plans import ledger, tables
from strata.plans.bronze import DEFAULT_SOURCE_SYSTEM, bronze_from_files
from strata.plans.layers import Names
from strata.session import checkpoint_root


def raw_stream(spark: SparkSession, folder: str, header: list[str], sep: str = ";") -> DataFrame:
    """Streaming scan of CSV files with this header (recursive), every column a string, and ``_source_path``."""
    files = (
        spark.readStream.schema(StructType([StructField(h, StringType()) for h in header]))
        .options(header="true", sep=sep, mode="PERMISSIVE", enforceSchema="false", recursiveFileLookup="true", pathGlobFilter="*.csv")
        .csv(folder)
    )
    names = [F.col(f"`{h}`").alias(normalize_column_name(h)) for h in header]
    return files.select(*names, F.col("_metadata.file_path").alias("_source_path"))


def start_bronze_stream(
    spark: SparkSession,
    folder: str,
    header: list[str],
    table: str,
    checkpoint: str | None = None,
    source_system: str = DEFAULT_SOURCE_SYSTEM,
    available_now: bool = True,
    names: Names | None = None,
) -> StreamingQuery:
    """Start the ingestion; each micro-batch becomes one bronze load batch.

    The ledgers are those of ``names``, by default the tables named so in the namespace of ``table``.
    """
    namespace = table.rpartition(".")[0]
    default = Names()
    files, loads = (
        (names.files, names.loads) if names else (f"{namespace}.{t.rpartition('.')[2]}".lstrip(".") for t in (default.files, default.loads))
    )
    stream = normalize_column_name(table)
    checkpoint = checkpoint or f"{checkpoint_root(spark)}/streams/{stream}"
    columns = [normalize_column_name(h) for h in header]

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch_id = f"stream_{stream}_{epoch:012d}"
        session = batch.sparkSession  # the stream's own: it knows what files the writes below replace
        if tables.table_exists(session, files):
            others = session.table(files).where(F.col("_batch_id") != batch_id).select("_source_path")
            batch = batch.join(others, "_source_path", "left_anti")
        bronze = bronze_from_files(batch, batch_id, columns, source_system)
        tables.replace_table(bronze, table, ["_batch_id"])
        # the epoch's partition: an epoch that comes again finds what it wrote before, whichever attempt that was
        mine = session.table(table).where(F.col("_batch_id") == batch_id)
        tables.replace_table(mine.select("_source_path", "_batch_id").distinct(), files, ["_batch_id"])
        n_files, n_rows = mine.agg(F.countDistinct("_source_path"), F.count(F.lit(1))).first()
        ledger.record(session, loads, batch_id, ledger.FINISHED, tables.PARQUET, files=n_files, rows=n_rows, malformed=0)

    writer = raw_stream(spark, folder, header).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
