"""Lineage columns stamped on every layer (bronze, silver, gold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _value(v, default: Column | None = None) -> Column:
    if v is None:
        return default
    return v if isinstance(v, Column) else F.lit(v)


def _time(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def add_bronze_metadata(
    df: DataFrame,
    source_system: str | Column,
    batch_id: str | Column,
    source_path: Column | None = None,
    as_of=None,
) -> DataFrame:
    """Source file, source system, load batch, load time and layer.

    ``source_path`` defaults to the scan's hidden ``_metadata.file_path``
    (spelled ``file:/...``), which costs nothing extra in a file scan.
    """
    return df.withColumns(
        {
            "_source_path": _value(source_path, F.col("_metadata.file_path")),
            "_source_system": _value(source_system),
            "_batch_id": _value(batch_id),
            "_ingested_at": _time(as_of),
            "_layer": F.lit("bronze"),
        }
    )


def add_silver_metadata(df: DataFrame, batch_id: str | Column | None = None, as_of=None) -> DataFrame:
    """Silver batch, load time and layer; ``batch_id=None`` keeps the incoming ``_batch_id``."""
    return df.withColumns(
        {
            "_batch_id": _value(batch_id, F.col("_batch_id")),
            "_ingested_at": _time(as_of),
            "_layer": F.lit("silver"),
        }
    )


def add_gold_metadata(df: DataFrame, batch_id: str | Column | None = None, as_of=None) -> DataFrame:
    """Gold batch, load time and layer; ``batch_id=None`` keeps the incoming ``_batch_id``."""
    return df.withColumns(
        {
            "_batch_id": _value(batch_id, F.col("_batch_id")),
            "_gold_ingested_at": _time(as_of),
            "_layer": F.lit("gold"),
        }
    )
