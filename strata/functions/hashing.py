"""Content fingerprints and deterministic surrogate keys (SHA-256, JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.constants import HASH_NULL_TOKEN, HASH_SEPARATOR


def record_hash(columns: Iterable[str]) -> Column:
    """SHA-256 hex of the string casts joined by the separator; NULL counts as ''."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def hash_key(columns: Iterable[str], namespace: str | None = None) -> Column:
    """Surrogate key: SHA-256 hex of namespace + trimmed casts, NULL spelled as a token.

    The namespace keeps equal natural values of different dimensions apart.
    """
    parts = [F.lit(namespace)] if namespace else []
    parts += [F.coalesce(F.trim(F.col(c).cast("string")), F.lit(HASH_NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def _require(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing for {what}: {missing}")


def add_record_hash(df: DataFrame, payload_columns: list[str], name: str = "_record_hash") -> DataFrame:
    _require(df, payload_columns, name)
    return df.withColumn(name, record_hash(payload_columns))


def add_hash_key(
    df: DataFrame, key_columns: list[str], name: str, namespace: str | None = None
) -> DataFrame:
    _require(df, key_columns, name)
    return df.withColumn(name, hash_key(key_columns, namespace))
