"""Persisted medallion run: raw CSV folder -> bronze -> silver -> gold tables.

Table layout chosen for the queries that follow:
* bronze is partitioned by ``_batch_id``: a silver run reads one batch by
  partition pruning;
* silver movement and the fact are partitioned by ``id_cmpt_movel``: snapshot
  replacement rewrites only the touched months (dynamic partition overwrite,
  one commit) and latest-month reports prune to one folder;
* the fact and the plan dimension are clustered by the plan's key;
* the reject table is partitioned by ``_batch_id`` and replaced per batch.

* entities and dimensions are in buckets by their key: a merge reads the
  buckets it hits and rewrites those in which a row changed.

Small ledgers keep loads from looking through tables: the load ledger says what
each load has come to, with the counters observed while it wrote; the file ledger has
a row per loaded file, the month ledger a row per silver batch and month.  A
bronze batch counts only when its files are in the ledger.  A batch is cleared
by the record of its own load alone (``strata.plans.ledger``): a batch of
another writer, a stream or a load that still runs, is left alone.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_batch_id
from strata.operators.quality import ensure_not_empty, require_columns
from strata.operators.staging import in_scratch, stage
from strata.plans import gold, ledger, silver, tables
from strata.plans.bronze import DEFAULT_SOURCE_SYSTEM, bronze_from_files, check_contract
from strata.plans.tables import PARQUET, Clustering, Storage
from strata.sources.csv import PATH, folders_to_list, headers_of, layouts, list_files, read_csv

#: New files that one pass of a load reads; a load makes as many passes as it needs.
FILES_AT_ONCE = 10_000

#: A load that started longer ago and never ended is taken for dead.
STALE_AFTER = _dt.timedelta(days=1)

#: Column with the text of malformed lines while a load reads them.
MALFORMED = "_malformed_line"

#: Buckets that entities and dimensions are created with, by how many keys they have.
FEW_KEYS, MANY_KEYS = 8, 32

#: The fact and its largest dimension, plans, are cut alike, so that they join without a shuffle.
BY_PLAN = Clustering(("sk_plano",), 16)


def new_batch_id() -> str:
    """'YYYYMMDDHHMMSS_<8 hex>': string order is time order."""
    return _dt.datetime.now().strftime("%Y%m%d%H%M%S") + "_" + uuid.uuid4().hex[:8]


@dataclass(frozen=True)
class Names:
    bronze: str = "bronze.beneficiarios"
    files: str = "bronze.arquivos_carregados"
    loads: str = "bronze.cargas"
    malformed: str = "bronze.linhas_malformadas"
    closed: str = "bronze.competencias_fechadas"
    insurer: str = "silver.operadora"
    municipality: str = "silver.municipio"
    plan: str = "silver.plano"
    movement: str = "silver.beneficiario_movimento"
    rejected: str = "silver.beneficiario_rejeitado"
    months: str = "silver.meses_do_lote"
    dim_insurer: str = "gold.dim_operadora"
    dim_municipality: str = "gold.dim_municipio"
    dim_plan: str = "gold.dim_plano"
    dim_profile: str = "gold.dim_perfil_beneficiario"
    fact: str = "gold.fato_beneficiario_movimento"


@in_scratch
def load_bronze(
    spark: SparkSession,
    raw_folder: str,
    names: Names = Names(),
    batch_id: str | None = None,
    source_system: str = DEFAULT_SOURCE_SYSTEM,
    force: bool = False,
    storage: Storage = PARQUET,
    columns: list[str] = silver.RAW_COLUMNS,
    extra_columns: str = "error",
    malformed: str = "keep",
    closed_periods: str = "skip",
    stale_after: _dt.timedelta = STALE_AFTER,
) -> dict:
    """Append the rows of raw files not loaded before; returns the run counters.

    Headers of all new files are held against the contract before a row is
    written.  Lines with more or fewer cells than their header are
    counted and recorded with their text in ``names.malformed``; with
    ``malformed="keep"`` their cells are also loaded, as a permissive reader does, with ``"quarantine"`` they are not.
    Folders of periods closed by ``ledger.close_periods`` are not listed, unless ``closed_periods="list"``.
    Counters are observed in the write; what was written is not read again.
    """
    if malformed not in ("keep", "quarantine"):
        raise ValueError(f"malformed lines are kept or in quarantine, not {malformed!r}")
    batch_id = batch_id or new_batch_id()
    ledger.clear_unfinished(spark, names.loads, [names.bronze, names.malformed], storage, stale_after)
    counters = {"batch_id": batch_id, "files": 0, "rows": 0, "malformed": 0}
    closed = ledger.closed_periods(spark, names.closed) if closed_periods == "skip" else set()
    folders = folders_to_list(spark, raw_folder, closed) if closed else [raw_folder]
    if not folders:
        return counters
    new = list_files(spark, folders)
    if not force and tables.table_exists(spark, names.files):
        new = new.join(spark.table(names.files).select(PATH), PATH, "left_anti")
    new = stage(new.select("path", PATH), "new-files")
    total = new.count()
    if not total:
        return counters
    passes = [[r["path"] for r in new.orderBy(PATH).select("path").offset(k).limit(FILES_AT_ONCE).collect()] for k in range(0, total, FILES_AT_ONCE)]
    headers = [stage(headers_of(spark, paths), "headers") for paths in passes]
    have = {name for found in headers for own in layouts(spark, found).values() for name in own}
    check_contract(have, columns, extra_columns)
    ledger.record(spark, names.loads, batch_id, ledger.STARTED, storage)
    try:
        for paths, found in zip(passes, headers):
            counts = _load_files(spark, paths, found, names, batch_id, source_system, storage, columns, malformed)
            counters |= {k: counters[k] + counts[k] for k in ("files", "rows", "malformed")}
        loaded = new.select(PATH, F.lit(batch_id).alias("_batch_id"))
        tables.append(loaded, names.files, ["_batch_id"], storage, {"_batch_id": batch_id})
    except Exception:
        ledger.record(spark, names.loads, batch_id, ledger.FAILED, storage)
        raise
    counts = {k: counters[k] for k in ("files", "rows", "malformed")}
    ledger.record(spark, names.loads, batch_id, ledger.FINISHED, storage, **counts)
    return counters


def _load_files(
    spark: SparkSession, paths: list[str], headers: DataFrame, names: Names, batch_id: str, source_system: str, storage: Storage, columns: list[str], malformed: str
) -> dict:
    """Append the rows of ``paths`` to the batch in one scan, counted on their way."""
    none = {"files": 0, "rows": 0, "malformed": 0}
    if headers.isEmpty():
        return none
    raw = read_csv(spark, paths, malformed=MALFORMED, headers=headers)
    lacking = [F.lit(None).cast("string").alias(c) for c in columns if c not in raw.columns]  # other passes have them
    raw = raw.select("*", *lacking)
    lines, written = Observation(), Observation()
    counted = raw.observe(lines, F.count(MALFORMED).alias("malformed"))
    kept = counted if malformed == "keep" else counted.where(F.col(MALFORMED).isNull())
    # files are as many as a pass has
    kept = kept.observe(written, F.count(F.lit(1)).alias("rows"), F.size(F.collect_set(F.xxhash64(PATH))).alias("files"))
    bronze = bronze_from_files(kept.drop(MALFORMED), batch_id, columns, source_system, extra_columns="drop")
    tables.append(bronze, names.bronze, ["_batch_id"], storage, {"_batch_id": batch_id})
    counts = none | lines.get | written.get
    if counts["malformed"]:
        seen = raw.where(F.col(MALFORMED).isNotNull()).select(PATH, F.col(MALFORMED).alias("linha"), F.lit(batch_id).alias("_batch_id"))
        tables.append(seen, names.malformed, ["_batch_id"], storage, {"_batch_id": batch_id})
    return counts


def _latest_load(spark: SparkSession, names: Names) -> str:
    """The batch that was finished last; without load records, the greatest id in the file ledger."""
    found = ledger.latest_finished(spark, names.loads) if tables.table_exists(spark, names.loads) else None
    return found or latest_batch_id(spark.table(names.files))


@in_scratch
def load_silver(
    spark: SparkSession,
    names: Names = Names(),
    batch_id: str | None = None,
    full_snapshot: bool = True,
    storage: Storage = PARQUET,
) -> str:
    """Clean, validate and persist one bronze batch into the five silver tables."""
    batch_id = batch_id or _latest_load(spark, names)
    sliced = spark.table(names.bronze).where(F.col("_batch_id") == batch_id)
    ensure_not_empty(sliced, f"bronze batch {batch_id}")
    classified = stage(silver.classify_movement(silver.clean_movement(sliced, batch_id=batch_id)), "silver-classified")
    valid = silver.valid_movement(classified)
    for rows, name, spec, buckets in (
        (silver.silver_insurer(valid), names.insurer, silver.INSURER, FEW_KEYS),
        (silver.silver_municipality(valid), names.municipality, silver.MUNICIPALITY, FEW_KEYS),
        (silver.silver_plan(valid), names.plan, silver.PLAN, MANY_KEYS),
    ):
        tables.merge_table(rows, name, spec.keys, storage=storage, buckets=buckets)
    movement = silver.silver_movement(valid)
    if full_snapshot:
        tables.replace_table(movement, names.movement, ["id_cmpt_movel"], storage=storage)
    else:
        tables.merge_table(movement, names.movement, silver.MOVEMENT_KEY, partition_by=["id_cmpt_movel"], storage=storage)
    batch = [{"_batch_id": batch_id}]
    rejected = silver.silver_rejected(classified)
    tables.replace_table(rejected, names.rejected, ["_batch_id"], values=batch, storage=storage)
    months = valid.select(F.lit(batch_id).alias("_batch_id"), "id_cmpt_movel").distinct()
    tables.replace_table(months, names.months, ["_batch_id"], values=batch, storage=storage)
    return batch_id


@in_scratch
def load_gold(
    spark: SparkSession,
    names: Names = Names(),
    batch_id: str | None = None,
    full_snapshot: bool = True,
    storage: Storage = PARQUET,
) -> str:
    """Dimensions from silver, profiles and the fact from the batch's movement.

    The month ledger names the batch's months, so that only their partitions
    of the movement are read.
    """
    months = spark.table(names.months)
    batch_id = batch_id or latest_batch_id(months)
    mine = months.where(F.col("_batch_id") == batch_id).select("id_cmpt_movel")
    movement = spark.table(names.movement)
    inputs = [
        (spark.table(names.insurer), silver.INSURER),
        (spark.table(names.municipality), silver.MUNICIPALITY),
        (spark.table(names.plan), silver.PLAN),
        (movement, silver.MOVEMENT),
    ]
    for frame, spec in inputs:
        require_columns(frame, [*spec.columns, "_record_hash"])
    # the months are a batch's few partition values: pruned by them, then filtered
    batch_movement = movement.join(F.broadcast(mine), "id_cmpt_movel", "left_semi").where(F.col("_batch_id") == batch_id)
    ensure_not_empty(batch_movement, f"silver batch {batch_id}")
    for frame, name, spec, buckets, clustering in (
        (gold.dim_insurer(inputs[0][0]), names.dim_insurer, gold.DIM_INSURER, FEW_KEYS, None),
        (gold.dim_municipality(inputs[1][0]), names.dim_municipality, gold.DIM_MUNICIPALITY, FEW_KEYS, None),
        (gold.dim_plan(inputs[2][0]), names.dim_plan, gold.DIM_PLAN, FEW_KEYS, BY_PLAN),
        (gold.dim_profile(batch_movement), names.dim_profile, gold.DIM_PROFILE, FEW_KEYS, None),
    ):
        tables.merge_table(frame, name, [spec.sk], storage=storage, buckets=buckets, clustering=clustering)
    fact = gold.fact_movement(batch_movement)
    if full_snapshot:
        tables.replace_table(fact, names.fact, ["id_cmpt_movel"], storage=storage, clustering=BY_PLAN)
    else:
        tables.merge_table(fact, names.fact, gold.FACT_KEY, partition_by=["id_cmpt_movel"], storage=storage, clustering=BY_PLAN)
    return batch_id
