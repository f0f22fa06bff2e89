"""Several text columns as one, and back.

In a shuffle each text of a row has a word for its place and length besides its
bytes, which compress badly as they differ from row to row.  One text with
separators is narrower.  Nulls, empty texts and texts with the separator come
back as they were, and texts are equal just if all that is in them is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR, ESCAPE = "\u0001", "\u0002"

#: What stands for an escape, a separator and a null.
ESCAPED, SEPARATED, ABSENT = (ESCAPE + c for c in "012")


def pack(columns: list[str]) -> Column:
    """One text of the text columns; never null."""
    plain = [F.replace(F.replace(c, F.lit(ESCAPE), F.lit(ESCAPED)), F.lit(SEPARATOR), F.lit(SEPARATED)) for c in map(F.col, columns)]
    return F.concat_ws(SEPARATOR, *[F.coalesce(c, F.lit(ABSENT)) for c in plain])


def unpack(df: DataFrame, packed: str, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` in place of the text that ``pack`` made of them."""
    # cut once: an array that several columns read is not computed by each of them
    rows = df.withColumn(packed, F.split(packed, SEPARATOR, -1))
    values = [F.get(packed, F.lit(i)) for i in range(len(columns))]
    plain = [F.replace(F.replace(v, F.lit(SEPARATED), F.lit(SEPARATOR)), F.lit(ESCAPED), F.lit(ESCAPE)) for v in values]
    each = {c: F.when(v != ABSENT, text) for c, v, text in zip(columns, values, plain)}
    return rows.withColumns(each).drop(packed)
