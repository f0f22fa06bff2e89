"""Incremental loads by source file: keep only rows of files not yet loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loaded_paths(target: DataFrame, path_column: str = "_source_path") -> DataFrame:
    """Distinct non-null source paths already present in ``target``."""
    return target.select(path_column).where(F.col(path_column).isNotNull()).distinct()


def new_rows_only(
    source: DataFrame,
    target: DataFrame | None,
    path_column: str = "_source_path",
    force: bool = False,
) -> DataFrame:
    """Rows of ``source`` whose file is not in ``target``'s ledger of paths.

    Bypassed when forced, when there is no target yet, or when the target has
    no path column.  The ledger holds one row per file (distinct with partial
    aggregation), so its size grows with the number of files, not rows; the
    anti-join is left to AQE, which broadcasts the ledger when it is small
    and otherwise shuffles both sides on the path (a path's rows all come
    from one file, which bounds any single key).
    """
    if force or target is None or path_column not in target.columns:
        return source
    return source.join(loaded_paths(target, path_column), path_column, "left_anti")


def load_counters(new_rows: DataFrame, path_column: str = "_source_path") -> DataFrame:
    """One row: files and rows about to be written, in a single aggregation."""
    return new_rows.agg(
        F.countDistinct(path_column).alias("files_written"),
        F.count(F.lit(1)).alias("rows_written"),
    )


def batch_slice(df: DataFrame, batch_id: str, column: str = "_batch_id") -> DataFrame:
    """Rows of one load batch; on a table partitioned by the batch this is a
    partition filter, so only that batch's files are read."""
    return df.where(F.col(column) == batch_id)
