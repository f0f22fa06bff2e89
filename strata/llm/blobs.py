"""Binary container files written and read by Spark.

Spark has no writer for files of raw bytes, but its text writer copies the
bytes of a string column unchecked, ends every row with ``lineSep`` and, with
``maxRecordsPerFile = 1``, puts every row in a file of its own.  A container
format whose files all end in the same ASCII bytes can thus be written through
Spark's commit protocol to any file system that Spark knows, and survives lost
executors and repeated tasks.  Reading goes through ``binaryFile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_blobs(blobs: DataFrame, path: str, ending: str) -> None:
    """One file per row of ``content`` (binary): the row's bytes, then ``ending``.

    Every row passes through one task's memory, so callers bound its size.
    """
    value = F.col("content").cast("string").alias("value")
    (
        blobs.select(value)
        .write.mode("errorifexists")
        .option("lineSep", ending)
        .option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .text(path)
    )


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """The files that ``write_blobs`` wrote, one row each: ``path``, ``content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where(F.col("length") > 0).select("path", "content")
