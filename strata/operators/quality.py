"""Declarative data-quality rules and the valid / rejected split.

A rule is a boolean ``Column`` that is true when a row FAILS, plus the
reason text recorded for it.  All rules of a layer are evaluated in one
projection that computes the concatenated reason; the valid and rejected
outputs are then two filters over that single column, so the cleaning pass
is never evaluated per rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.constants import MISSING_SUFFIX, REASON_SEPARATOR

REASON_COLUMN = "_rejection_reason"


@dataclass(frozen=True)
class Rule:
    fails: Column
    reason: str


def require_columns(df: DataFrame, expected: list[str]) -> None:
    """Raise with the sorted missing names; schema-only, runs no job."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def any_null(columns: list[str]) -> Column:
    """Whether one of ``columns`` is NULL; false for an empty list."""
    return reduce(or_, (F.isnull(c) for c in columns), F.lit(False))


def any_fails(rules: list[Rule]) -> Column:
    """Whether one of ``rules`` is sure to fail; one that is null has not failed."""
    return reduce(or_, (F.coalesce(rule.fails, F.lit(False)) for rule in rules), F.lit(False))


def _joined(reasons: list[Column]) -> Column:
    """The reasons that apply, in order; NULL when none does."""
    text = F.array_join(F.array(*reasons).cast("array<string>"), REASON_SEPARATOR)  # skips nulls
    return F.nullif(text, F.lit(""))


def _absent(columns: list[str]) -> list[Column]:
    return [F.when(F.isnull(c), c + MISSING_SUFFIX) for c in columns]


def missing_reason(columns: list[str]) -> Column:
    """'<col> ausente' for each NULL column, joined; NULL when none is missing."""
    return _joined(_absent(columns))


def rejection_reason(required: list[str], rules: list[Rule]) -> Column:
    """All reasons of a row joined by '; ', or NULL for a valid row."""
    return _joined(_absent(required) + [F.when(rule.fails, rule.reason) for rule in rules])


def classify(df: DataFrame, required: list[str], rules: list[Rule]) -> DataFrame:
    """Add ``_rejection_reason`` (NULL = valid).  One pass for every rule.

    The reason is generated, one per row, since a filter on a generated column stays above it.
    On a projected one the optimizer copies all rules, and the cleaning that they read, into the filter.
    """
    reason = rejection_reason(required, rules)
    return df.select(*[c for c in df.columns if c != REASON_COLUMN], F.explode(F.array(reason)).alias(REASON_COLUMN))


def valid_part(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON_COLUMN).isNull()).drop(REASON_COLUMN)


def rejected_part(classified: DataFrame, as_of=None) -> DataFrame:
    at = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return classified.where(F.col(REASON_COLUMN).isNotNull()).withColumn("_rejected_at", at)


def ensure_not_empty(df: DataFrame, what: str) -> None:
    """Raise when ``df`` has no row; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"no rows found for {what}")
