"""Table maintenance as pure DataFrame functions: SCD1 merge and partition replace.

Both return the new content of the target; ``strata.plans.tables`` persists it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _null_safe_match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality where nulls are equal; plain where a side has no nulls, so that rows which lie by the key need no shuffle."""
    nullable = {k: left.schema[k].nullable and right.schema[k].nullable for k in keys}
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) if nullable[k] else left[k] == right[k] for k in keys])


def unique_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with one row per key; reading a key that occurs twice fails the query.

    The check is part of the plan: rows are combined per key before the
    shuffle that the merge join needs anyway, and no job runs beforehand.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*rest)) if rest else F.lit(None)
    one = df.groupBy(*keys).agg(row.alias("row"), F.count("*").alias("n"))
    twice = F.concat(F.lit(f"source has duplicate keys {keys}: "), F.to_json(F.struct(*keys)))
    # the check guards a key column, so that no column pruning can remove it
    checked = F.when(F.col("n") > 1, F.raise_error(twice).cast(df.schema[keys[0]].dataType)).otherwise(F.col(keys[0]))
    return one.select(
        [
            checked.alias(c) if c == keys[0] else F.col(c) if c in keys else F.col(f"row.{c}").alias(c)
            for c in df.columns
        ]
    )


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    compare_hash: str | None = "_record_hash",
    non_update: list[str] | None = None,
) -> DataFrame:
    """The rows of ``source`` that a merge would insert or update with: the change feed of the two.

    Only keys and hashes of ``target`` are read.
    """
    updatable = set(target.columns) - set(keys) - set(non_update or [])
    by_hash = bool(updatable) and compare_hash in target.columns
    t = target.select(*keys, *([compare_hash] if by_hash else [])).alias("t")
    s = source.alias("s")
    same = _null_safe_match(s, t, keys)
    if by_hash:  # as in the merge, a null hash on either side is no change
        same = same & F.coalesce(F.col(f"s.{compare_hash}") == F.col(f"t.{compare_hash}"), F.lit(True))
    elif updatable:
        return source
    return s.join(t, same, "left_anti")


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    compare_hash: str | None = "_record_hash",
    non_update: list[str] | None = None,
) -> DataFrame:
    """SCD type-1 merge: insert new keys, overwrite changed rows, keep the rest.

    Keys match null-safely (``<=>``), which Catalyst plans as an equi-join on
    (coalesced value, is-null flag), not a nested loop; keys that the schema of a
    side holds non-null match by plain equality.  A matched row is
    updated only when the hashes differ; a NULL hash on either side compares
    as "no update", as SQL ``<>`` does.  ``non_update`` columns keep the
    target's value on update.  With nothing updatable the merge only inserts.
    The full outer join shuffles both sides once on the keys, or only the source
    where the target lies by them; each key occurs at most once per side, so no key can be hot.
    """
    non_update = list(non_update or [])
    missing = sorted(set(keys) - set(source.columns))
    if missing:
        raise ValueError(f"key columns missing in source: {missing}")
    columns = target.columns
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = unique_by(source.select(*columns), keys).withColumn("__s", F.lit(True)).alias("s")
    joined = t.join(s, _null_safe_match(t, s, keys), "full_outer")

    t_present = F.col("t.__t").isNotNull()
    s_present = F.col("s.__s").isNotNull()
    updatable = [c for c in columns if c not in keys and c not in non_update]
    if updatable and compare_hash and compare_hash in columns:
        changed = F.coalesce(F.col(f"t.{compare_hash}") != F.col(f"s.{compare_hash}"), F.lit(False))
    else:
        changed = F.lit(bool(updatable))
    take_source = ~t_present | (s_present & changed)

    out = []
    for c in columns:
        if c in keys:
            out.append(F.when(t_present, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        elif c in updatable:
            out.append(F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(t_present, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*out)


def replace_frames(
    target: DataFrame,
    source: DataFrame,
    partition_columns: list[str],
    values: DataFrame | None = None,
) -> DataFrame:
    """Drop every target row whose partition values occur in ``source`` (or in
    the optional explicit ``values``), then append ``source``.

    The anti-join's other side is the distinct values, each a partition of the
    table, so they are broadcast: the target's rows stay where they are.
    """
    missing = sorted(set(partition_columns) - set(source.columns))
    if missing:
        raise ValueError(f"partition columns missing in source: {missing}")
    keys = source.select(*partition_columns)
    if values is not None:
        keys = keys.unionByName(values.select(*partition_columns))
    t = target.alias("t")
    k = F.broadcast(keys.distinct()).alias("k")
    kept = t.join(k, _null_safe_match(t, k, partition_columns), "left_anti")
    return kept.unionByName(source.select(*target.columns))
