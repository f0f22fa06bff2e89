"""Column-name normalisation and whole-frame string casting.

Renaming is metadata only: it runs on the driver over the schema, never
over rows.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_column_name(name: str) -> str:
    """The runs of [a-z0-9] in the lower-cased name without accents, joined by '_'."""
    spelled = unicodedata.normalize("NFKD", name)
    accents = dict.fromkeys(map(ord, filter(unicodedata.combining, spelled)))
    return "_".join(re.findall(r"[a-z0-9]+", spelled.translate(accents).lower()))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``normalize_column_name``; raise if two collide."""
    names = [normalize_column_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    clashes = []
    for original, new in zip(df.columns, names):
        if new in seen:
            clashes.append(f"{seen[new]!r} and {original!r} -> {new!r}")
        seen.setdefault(new, original)
    if clashes:
        raise ValueError("column names collide after normalisation: " + "; ".join(clashes))
    return df.toDF(*names)


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
