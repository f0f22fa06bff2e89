"""Scalar cleaning functions: each returns a Spark ``Column`` expression.

All of them stay inside Catalyst (no Python UDF).  Under ANSI mode the
lenient ``try_*`` forms are used wherever a bad value must become NULL
instead of failing the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.constants import DATE_FORMATS, NULL_TOKENS

ColumnLike = "str | Column"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c, null_tokens: list[str] | None = None) -> Column:
    """Cast to string, trim spaces, and map null tokens (case-insensitive) to NULL."""
    tokens = NULL_TOKENS if null_tokens is None else null_tokens
    absent = F.array(*map(F.lit, tokens)).cast("array<string>")
    trimmed = F.array(F.trim(as_column(c).cast("string")))
    # a lambda binds the trimmed value once, and a projection with one is no part of a whole
    # stage's method, which grows with the columns beyond the 8,000 bytes that the JVM compiles
    return F.get(F.transform(trimmed, lambda v: F.when(~F.array_contains(absent, F.upper(v)), v)), F.lit(0))


def clean_upper(c) -> Column:
    """``clean_string`` then upper case."""
    return F.upper(clean_string(c))


def only_digits(c) -> Column:
    """Keep the digits of the cleaned value; NULL when none remain."""
    # a null token has no digit, so it needs no test of its own
    return F.nullif(F.regexp_replace(as_column(c).cast("string"), r"[^0-9]", ""), F.lit(""))


def parse_long(c) -> Column:
    """Keep digits and '-', then read a signed 64-bit integer; NULL if malformed or out of range."""
    kept = F.regexp_replace(as_column(c).cast("string"), r"[^0-9-]", "")  # null tokens have no digit
    return F.when(kept.rlike(r"^-?[0-9]+$"), kept.try_cast("long")).otherwise(
        F.lit(None).cast("long")
    )


def _layout_regex(fmt: str) -> str:
    """Strict shape of a numeric date layout: 'dd/MM/yyyy' -> '^[0-9]{2}/[0-9]{2}/[0-9]{4}$'."""
    out, i = "^", 0
    while i < len(fmt):
        j = i
        while j < len(fmt) and fmt[j] == fmt[i]:
            j += 1
        run = j - i
        out += f"[0-9]{{{run}}}" if fmt[i].isalpha() else re.escape(fmt[i]) * run
        i = j
    return out + "$"


def parse_date(c, formats: list[str] | None = None) -> Column:
    """First layout that parses wins; NULL when none does.

    Each layout is tried only on values of its exact shape, so the parser
    never fails (a failed parse costs an exception per row) and layouts stay
    strict (no one-digit months or five-digit years).
    """
    value = F.trim(as_column(c).cast("string"))  # no layout has the shape of a null token
    return F.coalesce(
        *[F.when(value.rlike(_layout_regex(fmt)), F.try_to_date(value, fmt)) for fmt in (formats or DATE_FORMATS)]
    )


def in_domain(c, allowed: list[str]) -> Column:
    """Keep the value when it is one of ``allowed``; NULL otherwise."""
    col = as_column(c)
    return F.when(col.isin(allowed), col).otherwise(F.lit(None).cast("string"))
