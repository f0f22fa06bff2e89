"""Bronze layer: raw strings + lineage + content hash, appended per new file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import add_record_hash
from strata.operators.lineage import add_bronze_metadata

DEFAULT_SOURCE_SYSTEM = "ANS"


def check_contract(have: set[str], columns: list[str], extra_columns: str = "error") -> None:
    if missing := sorted(set(columns) - have):
        raise ValueError(f"raw files lack the columns {missing}")
    if (more := sorted(have - set(columns))) and extra_columns != "drop":
        raise ValueError(f"raw files have columns outside the contract: {more}")


def bronze_from_files(
    raw: DataFrame,
    batch_id: str | Column,
    columns: list[str],
    source_system: str = DEFAULT_SOURCE_SYSTEM,
    as_of=None,
    extra_columns: str = "error",
) -> DataFrame:
    """The contract's ``columns`` as strings, lineage, and a hash of the columns in that order.

    ``raw`` comes from ``read_csv``.  A row thus has one hash, whatever the
    order of columns in its file or the other files of its load.  Contract
    columns that no file has are an error; further columns are one too,
    unless ``extra_columns`` is ``"drop"``.
    """
    check_contract(set(raw.columns) - {"_source_path"}, columns, extra_columns)
    strings = raw.select(*[F.col(c).cast("string").alias(c) for c in columns], "_source_path")
    stamped = add_bronze_metadata(
        strings, source_system, batch_id, source_path=F.col("_source_path"), as_of=as_of
    )
    return add_record_hash(stamped, columns)


def bronze_from_frame(
    raw: DataFrame,
    payload: list[str],
    source_system: str = DEFAULT_SOURCE_SYSTEM,
) -> DataFrame:
    """Bronze for a frame that already carries its load context
    (``_source_path``, ``_batch_id``, ``_ingested_at``), e.g. several simulated
    deliveries at once."""
    stamped = add_bronze_metadata(
        raw.select(*payload, "_source_path", "_batch_id", "_ingested_at"),
        source_system,
        F.col("_batch_id"),
        source_path=F.col("_source_path"),
        as_of=F.col("_ingested_at"),
    )
    return add_record_hash(stamped, payload)
