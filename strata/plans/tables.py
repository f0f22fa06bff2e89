"""Persisting layers as catalog tables: create/append, SCD1 merge, partition replace.

``Storage`` names the table format.  In a catalog with row-level operations
(``row_level=True``, e.g. an Iceberg catalog) tables are written with
``writeTo`` and merged with ``mergeInto``.  In the session catalog's Parquet
tables

* a replace is one ``insertInto(overwrite=True)`` under dynamic partition
  overwrite: touched partitions change in one commit, others keep their files;
* a merge into a partitioned table whose partition columns are key columns is
  such a replace of the partitions in which the source changes a row;
* a table without such columns can be created in ``buckets``: partitions by a
  hash of the key, which its properties name, so that a merge reads the buckets that the source
  hits and rewrites those in which it changes a row, in one commit;
* any other merge writes the new content to ``<table>__next`` and swaps it in
  by renames.  The old content stays as ``<table>__prev`` until the new one is
  in place; a swap that was cut short is completed or undone by the next write.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import changed_rows, merge_frames, unique_by
from strata.operators.staging import scratch, stage

DYNAMIC_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"

#: Partition column of tables in buckets, and the table property with their number and the keys.
BUCKET = "_bucket"
BUCKETED_BY = "strata.bucketed-by"


@dataclass(frozen=True)
class Storage:
    """How tables are stored; ``location`` is the folder of new namespaces."""

    format: str = "parquet"
    row_level: bool = False
    location: str | None = None


PARQUET = Storage()


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup only; read errors on an existing table are not hidden."""
    return spark.catalog.tableExists(name)


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create ``db`` or ``catalog.db`` (at ``location`` if given) and check that it is visible."""
    at = "" if location is None else " LOCATION :location"
    given = {"name": namespace} | ({} if location is None else {"location": location})
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name){at}", args=given)
    assert_namespace(spark, namespace)


def assert_namespace(spark: SparkSession, namespace: str) -> None:
    if not spark.catalog.databaseExists(namespace):
        raise RuntimeError(f"namespace {namespace} was not created or is not visible")


def ensure_table_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """For 'db.table' or 'catalog.db.table' make sure that the namespace exists in its catalog."""
    namespace, _, _ = name.rpartition(".")
    if namespace:
        ensure_namespace(spark, namespace, location)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _gathered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows of a partition meet before the write, so that it gets few files; AQE splits a hot one."""
    return df.hint("rebalance", *partition_by) if partition_by else df


@dataclass(frozen=True)
class Clustering:
    """Files cut and sorted by a hash of ``columns``; tables that share it join on them without a shuffle."""

    columns: tuple[str, ...]
    n: int


def create_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, storage: Storage = PARQUET, clustering: Clustering | None = None
) -> None:
    """``clustering`` is kept by later writes of a Parquet table; a catalog with row-level operations has its own means."""
    ensure_table_namespace(df.sparkSession, name, storage.location)
    rows = _gathered(df, partition_by)
    if storage.row_level:
        writer = rows.writeTo(name).using(storage.format)
        (writer.partitionedBy(*map(F.col, partition_by)) if partition_by else writer).create()
        return
    writer = rows.write.format(storage.format).mode("errorifexists")
    if clustering:
        writer = writer.bucketBy(clustering.n, *clustering.columns).sortBy(*clustering.columns)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def append(
    df: DataFrame, name: str, partition_by: list[str] | None = None, storage: Storage = PARQUET, into: dict[str, str] | None = None
) -> None:
    """Create the table from the first write; afterwards append by column name.

    ``into`` names the one partition that all rows belong to, e.g. that of a load.  It is
    then written in its own folder, and loads of other partitions may run at the same time;
    otherwise Parquet tables take one append at a time, as their writer's folder for unfinished files is the table's.
    """
    spark = df.sparkSession
    recover(spark, name)
    if into and not storage.row_level:
        _append_partition(df, name, into, storage)
    elif not table_exists(spark, name):
        create_table(df, name, partition_by, storage)
    elif storage.row_level:
        _gathered(df, partition_by).writeTo(name).append()
    else:
        existing = partition_columns(spark, name)
        writer = _gathered(df, existing).write.format(storage.format).mode("append")
        (writer.partitionBy(*existing) if existing else writer).saveAsTable(name)


def _append_partition(df: DataFrame, name: str, into: dict[str, str], storage: Storage) -> None:
    ((column, value),) = into.items()
    spark = df.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", value):
        raise ValueError(f"a partition's folder cannot be named after {value!r}")
    if not table_exists(spark, name):
        try:
            create_table(spark.createDataFrame([], df.schema), name, [column], storage)  # not df: its metrics belong to the append
        except AnalysisException:  # another load was first
            if not table_exists(spark, name):
                raise
    if partition_columns(spark, name) != [column]:
        raise ValueError(f"{name} is partitioned by {partition_columns(spark, name)}, not by {column}")
    rows = df.select([c for c in spark.table(name).columns if c != column])
    rows.write.format(storage.format).mode("append").save(f"{location(spark, name)}/{column}={value}")
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD IF NOT EXISTS PARTITION (`{column}` = '{value}')", args={"name": name})
    spark.catalog.refreshTable(name)


def location(spark: SparkSession, name: str) -> str:
    """The folder of a table."""
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    return described.where("col_name = 'Location'").first()["data_type"]


def rows_of(spark: SparkSession, name: str) -> DataFrame:
    """The table without the column that only its layout needs."""
    return spark.table(name).drop(BUCKET)


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) RENAME TO {to}", args={"name": name})


def recover(spark: SparkSession, name: str) -> None:
    """Undo or complete a swap that was cut short.

    The table is gone only between the swap's two renames; ``__next`` is then
    complete, and its rename is repeated.  Where the table is there, leftovers
    of a swap are dropped: ``__prev`` is older, and ``__next`` may be unfinished.
    """
    here, previous, upcoming = (table_exists(spark, name + end) for end in ("", "__prev", "__next"))
    if not here and previous:
        _rename(spark, f"{name}__next" if upcoming else f"{name}__prev", name)
        previous = upcoming
    elif here and upcoming:
        _drop(spark, f"{name}__next")
    if previous:
        _drop(spark, f"{name}__prev")


def _swap(spark: SparkSession, content: DataFrame, name: str, storage: Storage) -> None:
    create_table(content, f"{name}__next", partition_columns(spark, name) or None, storage)
    _rename(spark, name, f"{name}__prev")
    _rename(spark, f"{name}__next", name)
    _drop(spark, f"{name}__prev")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    previous = spark.conf.get(DYNAMIC_OVERWRITE)
    spark.conf.set(DYNAMIC_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(DYNAMIC_OVERWRITE, previous)


def _overwrite_partitions(rows: DataFrame, name: str, storage: Storage) -> None:
    """Replace the partitions that ``rows`` has, in one commit."""
    spark = rows.sparkSession
    parts = partition_columns(spark, name)
    ordered = _gathered(rows.select(*spark.table(name).columns), parts)
    if storage.row_level:
        ordered.writeTo(name).overwritePartitions()
        return
    with _dynamic_overwrite(spark):
        ordered.write.insertInto(name, overwrite=True)


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _bucketing(spark: SparkSession, name: str, keys: list[str]) -> int:
    """How many buckets the table is in; merging by other keys than it was created for is refused."""
    found = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name}).collect()}
    if BUCKETED_BY not in found:
        raise ValueError(f"{name} has buckets, but not the property {BUCKETED_BY}")
    n, *by = json.loads(found[BUCKETED_BY])
    if by != list(keys):
        raise ValueError(f"{name} is in buckets by {by}, not by {keys}")
    return n


def _create_bucketed(source: DataFrame, name: str, keys: list[str], n: int, storage: Storage, clustering: Clustering | None) -> None:
    """An empty table in buckets; the merge that follows fills it."""
    spark = source.sparkSession
    empty = spark.createDataFrame([], source.schema).withColumn(BUCKET, _bucket(keys, n))
    create_table(empty, name, [BUCKET], storage, clustering)
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ('{BUCKETED_BY}' = '{json.dumps([n, *keys])}')", args={"name": name})


def partitions_of(target: DataFrame, parts: list[str], values: list[tuple]) -> DataFrame:
    """The rows of ``target`` in the partitions with these values, as a filter that prunes partitions.

    Values are literals, and null has a branch of its own: a null-safe comparison would hide the column from pruning.
    """
    if len(parts) == 1:
        known = [v for (v,) in values if v is not None]
        condition = F.col(parts[0]).isin(known)
        return target.where(condition if len(known) == len(values) else condition | F.col(parts[0]).isNull())
    each = [
        reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(parts, row)]) for row in values
    ]
    return target.where(reduce(or_, each, F.lit(False)))


def _partition_values(df: DataFrame, parts: list[str]) -> list[tuple]:
    """The partitions that rows lie in: as many as a load touches."""
    return [tuple(r) for r in df.select(*parts).distinct().collect()]


def merge_table(
    source: DataFrame,
    name: str,
    keys: list[str],
    compare_hash: str | None = "_record_hash",
    non_update: list[str] | None = None,
    partition_by: list[str] | None = None,
    storage: Storage = PARQUET,
    buckets: int | None = None,
    clustering: Clustering | None = None,
) -> None:
    """SCD1 upsert of ``source`` into table ``name``, created on first use: in ``buckets`` if their number is given, and clustered."""
    spark = source.sparkSession
    if missing := sorted(set(keys) - set(source.columns)):
        raise ValueError(f"key columns missing in source: {missing}")
    recover(spark, name)
    if not table_exists(spark, name):
        if not buckets or storage.row_level:
            create_table(unique_by(source, keys), name, partition_by, storage, clustering)
            return
        _create_bucketed(source, name, keys, buckets, storage, clustering)
    if storage.row_level:
        merge_into(source, name, keys, compare_hash, non_update or [])
        return
    parts = partition_columns(spark, name)
    if parts == [BUCKET]:
        source = source.withColumn(BUCKET, _bucket(keys, _bucketing(spark, name, keys)))
        _merge_partitions(source, name, keys, parts, compare_hash, non_update, storage)
    elif parts and set(parts) <= set(keys):
        # a row's key holds its partition: others cannot match and are not read
        _merge_partitions(source, name, keys, parts, compare_hash, non_update, storage)
    else:
        _swap(spark, merge_frames(spark.table(name), source, keys, compare_hash, non_update), name, storage)


def _merge_partitions(
    source: DataFrame, name: str, keys: list[str], parts: list[str], compare_hash: str | None, non_update: list[str] | None, storage: Storage
) -> None:
    """Merge by rewriting, in one commit, the partitions in which a row is new or changed.

    Of the partitions that the source hits, keys and hashes are read; of those rewritten, whole rows.
    """
    spark = source.sparkSession
    target = spark.table(name)
    with scratch(spark):
        staged = stage(unique_by(source.select(*target.columns), keys), "merge-source")
        hit = partitions_of(target, parts, _partition_values(staged, parts))
        changes = stage(changed_rows(hit, staged, keys, compare_hash, non_update), "merge-changes")
        if rewritten := _partition_values(changes, parts):
            old = partitions_of(target, parts, rewritten)
            _overwrite_partitions(merge_frames(old, changes, keys, compare_hash, non_update), name, storage)


def merge_into(source: DataFrame, name: str, keys: list[str], compare_hash: str | None, non_update: list[str]) -> None:
    """The upsert as the catalog's own row-level merge."""
    new = source.alias("new")
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.expr(f"{name}.`{k}` <=> new.`{k}`")
    updatable = [c for c in source.columns if c not in keys and c not in non_update]
    merge = new.mergeInto(name, matched)
    if updatable:
        changed = F.expr(f"{name}.`{compare_hash}` <> new.`{compare_hash}`") if compare_hash in updatable else F.lit(True)
        merge = merge.whenMatched(changed).update({c: F.col(f"new.{c}") for c in updatable})
    merge.whenNotMatched().insertAll().merge()


def replace_table(
    source: DataFrame,
    name: str,
    partition_by: list[str],
    values: list[dict] | None = None,
    storage: Storage = PARQUET,
    clustering: Clustering | None = None,
) -> None:
    """Replace every partition of ``name`` whose values occur in ``source``, in one commit.

    ``values`` lists partitions to clear even when ``source`` has no row for
    them (e.g. a re-run that now rejects nothing).  Those that ``source`` lacks
    are dropped by one catalog change, after the commit if there is something to commit.
    A table that is not partitioned by just these columns is refused.
    """
    spark = source.sparkSession
    if missing := sorted(set(partition_by) - set(source.columns)):
        raise ValueError(f"partition columns missing in source: {missing}")
    if not table_exists(spark, name):
        create_table(source, name, partition_by, storage, clustering)
        return
    if not storage.row_level and partition_columns(spark, name) != list(partition_by):
        raise ValueError(f"{name} is partitioned by {partition_columns(spark, name)}, not by {partition_by}")
    if not values:
        _overwrite_partitions(source, name, storage)
        return
    with scratch(spark):
        staged = stage(source, "replacement")
        filled = set(_partition_values(staged, partition_by))
        if filled:
            _overwrite_partitions(staged, name, storage)
    if gone := [spec for spec in values if tuple(spec[c] for c in partition_by) not in filled]:
        clear_partitions(spark, name, gone, storage)


def clear_partition(spark: SparkSession, name: str, spec: dict, storage: Storage) -> None:
    clear_partitions(spark, name, [spec], storage)


def clear_partitions(spark: SparkSession, name: str, specs: list[dict], storage: Storage) -> None:
    """Remove the rows of these partitions; in a Parquet table all of them in one catalog change."""
    if storage.row_level:
        given = {f"v{i}_{j}": v for i, spec in enumerate(specs) for j, v in enumerate(spec.values())}
        each = [" AND ".join(f"`{k}` <=> :v{i}_{j}" for j, k in enumerate(spec)) for i, spec in enumerate(specs)]
        where = " OR ".join(f"({condition})" for condition in each)
        spark.sql(f"DELETE FROM IDENTIFIER(:name) WHERE {where}", args={"name": name} | given)
        return
    clauses = []
    for spec in specs:
        literal = {k: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for k, v in spec.items()}
        clauses.append("PARTITION (" + ", ".join(f"`{k}` = {v}" for k, v in literal.items()) + ")")
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS {', '.join(clauses)}", args={"name": name})


def inspect_layer(spark: SparkSession, database: str, table: str | None = None, n: int = 10):
    """Post-load check: the tables of a namespace and, optionally, ``n`` sample rows of one."""
    names = [t.name for t in spark.catalog.listTables(database)]
    sample = spark.table(f"{database}.{table}").limit(n) if table else None
    return names, sample
