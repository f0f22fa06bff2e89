"""Delimited raw files, read as lines and parsed by the header of their file.

Files of one source may order their columns differently, or have some more.
A reader that takes the first file's header for all shifts values between
columns.  Here every line is parsed with its own file's header: the headers
are the first lines of the files' first splits, found by Spark's text reader,
and only the distinct ones reach the driver.  Files with one header, the usual
case, need no join.  With more, lines are parsed by their number of cells, and
each value is taken from the place that the file's header names, so that the
plan grows with the widths of files and not with their headers.

A line whose cells are not as many as its header's is malformed.  It can be
asked for, with its text; its values are those of a permissive reader: missing
cells are NULL, further ones are dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.names import normalize_column_name
from strata.functions.packing import pack, unpack

PATH = "_source_path"
CORRUPT = "_corrupt"


def _lines(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    """Non-blank lines with their file and the start of their split.

    ``_metadata.file_path`` is the one spelling of a path used everywhere.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(paths)
    rows = text.select(
        F.regexp_replace("value", "^﻿", "").alias("line"),
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias("start"),
    )
    return rows.where(F.trim("line") != "")


def file_headers(lines: DataFrame) -> DataFrame:
    """``_source_path, header``: each file's first line.

    Row numbers grow within a split, and a file's first line is the first of
    its first split, however long it is.
    """
    first = lines.where("start = 0").withColumn("at", F.monotonically_increasing_id())
    return first.groupBy(PATH).agg(F.min_by("line", "at").alias("header"))


def headers_of(spark: SparkSession, paths: str | list[str], glob: str = "*.csv") -> DataFrame:
    """``_source_path, header`` of the files under ``paths``; files without a line have no row."""
    return file_headers(_lines(spark, paths, glob))


def _columns(spark: SparkSession, header: str, sep: str) -> list[str]:
    """The normalised column names of a header line."""
    if header.count('"') % 2:
        raise ValueError(f"a header that spans lines is not supported: {header[:80]!r}")
    cells = ", ".join(f"c{i} string" for i in range(header.count(sep) + 1))
    cells = spark.range(1).select(F.from_csv(F.lit(header), cells, {"sep": sep}).alias("r"))
    names = [normalize_column_name(c) for c in cells.select("r.*").first() if c is not None]
    if clash := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"column names collide after normalisation: {clash}")
    return names


def layouts(spark: SparkSession, headers: DataFrame, sep: str = ";") -> dict[str, list[str]]:
    """Column names by header, of the distinct headers in ``headers(header)``."""
    return {r["header"]: _columns(spark, r["header"], sep) for r in headers.select("header").distinct().orderBy("header").collect()}


def _record(width: int, sep: str) -> Column:
    """The cells of a line of ``width`` cells, and the line itself if it has more or less."""
    cells = ", ".join(f"c{i} string" for i in range(width))
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_csv("line", f"{cells}, {CORRUPT} string", options)


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = ";",
    glob: str = "*.csv",
    malformed: str | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """Every file under ``paths``, columns matched by normalised name, all strings, and ``_source_path``.

    A column that a file lacks is NULL there.  ``malformed`` names a column for the text of malformed
    lines, NULL for others.  Lines that repeat their file's header are left out.
    ``headers`` is what ``headers_of`` gave for these files, if it is known.
    """
    lines = _lines(spark, paths, glob)
    headers = file_headers(lines) if headers is None else headers
    columns = layouts(spark, headers, sep)
    if not columns:
        raise ValueError(f"no {glob} files with a header under {paths}")
    names = list(dict.fromkeys(n for own in columns.values() for n in own))
    if len(columns) == 1:
        ((header, own),) = columns.items()
        parsed = lines.where(F.col("line") != header).select(PATH, _record(len(own), sep).alias("r"))
        values = [F.col("r")[f"c{i}"].alias(n) for i, n in enumerate(own)]
        corrupt = F.col("r")[CORRUPT]
    else:
        place = {header: {n: i for i, n in enumerate(own)} for header, own in columns.items()}
        known = [(header, len(own), [place[header].get(n) for n in names]) for header, own in columns.items()]
        layout = spark.createDataFrame(known, "header string, width int, places array<int>")
        own = lines.join(headers.join(layout, "header"), PATH).where("line <> header")
        widths = sorted({width for _, width, _ in known})
        records = {width: F.when(F.col("width") == width, _record(width, sep)) for width in widths}
        parsed = own.select(PATH, "places", *(record.alias(f"r{width}") for width, record in records.items()))
        each = [F.when(F.col(f"r{w}").isNotNull(), F.array(*(F.col(f"r{w}")[f"c{i}"] for i in range(w)))) for w in widths]
        corrupt = F.coalesce(*(F.col(f"r{w}")[CORRUPT] for w in widths))
        parsed = parsed.select(PATH, "places", F.coalesce(*each).alias("cells"), corrupt.alias(CORRUPT))
        # a name that the header lacks has no place: get() of a null place is null
        values = [F.get("cells", F.get("places", F.lit(k))).alias(n) for k, n in enumerate(names)]
        corrupt = F.col(CORRUPT)
    extra = [] if malformed is None else [corrupt.alias(malformed)]
    return parsed.select(*values, *extra, PATH)


def list_files(spark: SparkSession, folders: str | list[str], glob: str = "*.csv") -> DataFrame:
    """``path`` (as readers take it) and ``_source_path`` of the files under ``folders``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folders)
    return files.select(_literal(F.col("path")).alias("path"), F.col("_metadata.file_path").alias(PATH))


#: What means something in the patterns that readers take for paths.
SPECIAL = r"([\\\[\]{}*?])"


def _literal(path: Column) -> Column:
    return F.regexp_replace(path, SPECIAL, r"\\$1")


def folders_to_list(spark: SparkSession, root: str, closed: set[str]) -> list[str]:
    """The parts of ``root`` that can hold new files: all but the folders of ``closed`` periods.

    One listing of ``root`` itself; what is in closed folders is not looked at.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    kept = [f.getPath() for f in found if not (f.isDirectory() and f.getPath().getName() in closed)]
    if len(kept) == len(found):
        return [root]
    return [re.sub(SPECIAL, r"\\\1", p.toString()) for p in kept if not p.getName().startswith(("_", "."))]


#: Rows of a compressed file, which one task reads.
ROWS_OF_A_COMPRESSED_FILE = 1_000_000


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, sep: str = ";", compression: str | None = None) -> None:
    """Header + separator, values written verbatim (no whitespace trimming).

    Rows are grouped by partition before the write, so that each folder gets
    few files; AQE splits a large one.  On their way, and while they are sorted
    by partition, a row's texts are one.  ``compression`` is the writer's, e.g. ``"gzip"``.
    """
    if partition_by:
        names = df.columns
        texts = [f.name for f in df.schema.fields if f.dataType == StringType() and f.name not in partition_by]
        if texts:
            df = df.select(*[c for c in names if c not in texts], pack(texts).alias("__texts"))
        df = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by)
        df = unpack(df, "__texts", texts).select(*names) if texts else df
    writer = df.write.mode("errorifexists").options(
        header="true", sep=sep, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    if compression:
        writer = writer.options(compression=compression, maxRecordsPerFile=ROWS_OF_A_COMPRESSED_FILE)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)
