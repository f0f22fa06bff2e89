"""Gold layer: a star schema with deterministic hash surrogate keys.

The fact never joins its dimensions: each ``sk_*`` is recomputed from the
natural key with the same hash the dimension uses, so building the fact is a
narrow (shuffle-free) projection of silver movement.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import add_hash_key, add_record_hash, hash_key
from strata.operators.dedupe import latest_per_key
from strata.operators.lineage import add_gold_metadata
from strata.plans.silver import COUNT_COLUMNS, PLAN_ATTRIBUTES

GOLD_META = ["_record_hash", "_batch_id", "_gold_ingested_at", "_layer"]


@dataclass(frozen=True)
class DimensionSpec:
    sk: str
    namespace: str
    keys: list[str]
    attributes: list[str]

    @property
    def columns(self) -> list[str]:
        return self.keys + self.attributes


# --- fixed values: surrogate-key namespaces ---------------------------------
DIM_INSURER = DimensionSpec("sk_operadora", "dim_operadora", ["cd_operadora"],
                            ["nm_razao_social", "nr_cnpj", "modalidade_operadora"])
DIM_MUNICIPALITY = DimensionSpec("sk_municipio", "dim_municipio", ["cd_municipio"], ["nm_municipio", "sg_uf"])
DIM_PLAN = DimensionSpec("sk_plano", "dim_plano", ["cd_operadora", "cd_plano"], PLAN_ATTRIBUTES)
DIM_PROFILE = DimensionSpec(
    "sk_perfil_beneficiario", "dim_perfil_beneficiario",
    ["tp_sexo", "de_faixa_etaria", "de_faixa_etaria_reaj", "tipo_vinculo"], [],
)
# --- end of fixed values ----------------------------------------------------

FACT_KEY = ["id_cmpt_movel", "sk_operadora", "sk_municipio", "sk_plano", "sk_perfil_beneficiario"]
PERIOD_COLUMNS = ["id_cmpt_movel", "ano_competencia", "mes_competencia", "dt_competencia", "ds_competencia"]
FACT_PAYLOAD = PERIOD_COLUMNS + FACT_KEY[1:] + COUNT_COLUMNS


def _finish(df: DataFrame, spec: DimensionSpec, batch_id, as_of) -> DataFrame:
    keyed = add_hash_key(df, spec.keys, spec.sk, spec.namespace)
    hashed = add_record_hash(keyed, [spec.sk] + spec.columns)
    return add_gold_metadata(hashed, batch_id=batch_id, as_of=as_of).select(spec.sk, *spec.columns, *GOLD_META)


def build_dimension(silver_entity: DataFrame, spec: DimensionSpec, batch_id=None, as_of=None) -> DataFrame:
    """Rows with a full natural key, one per key (deterministic), + sk + hash + lineage.

    ``batch_id=None`` carries the silver row's batch.
    """
    keyed = silver_entity
    for k in spec.keys:
        keyed = keyed.where(F.col(k).isNotNull())
    one_per_key = latest_per_key(keyed, spec.keys, ["_batch_id", "_record_hash"])
    return _finish(one_per_key.select(*spec.columns, "_batch_id"), spec, batch_id, as_of)


def dim_insurer(silver_insurer: DataFrame, batch_id=None, as_of=None) -> DataFrame:
    return build_dimension(silver_insurer, DIM_INSURER, batch_id, as_of)


def dim_municipality(silver_municipality: DataFrame, batch_id=None, as_of=None) -> DataFrame:
    return build_dimension(silver_municipality, DIM_MUNICIPALITY, batch_id, as_of)


def dim_plan(silver_plan: DataFrame, batch_id=None, as_of=None) -> DataFrame:
    return build_dimension(silver_plan, DIM_PLAN, batch_id, as_of)


def dim_profile(silver_movement: DataFrame, batch_id=None, as_of=None) -> DataFrame:
    """Distinct profile tuples of the movement (partial aggregation before the
    shuffle); the carried batch is the latest one the tuple appeared in."""
    keyed = silver_movement
    for k in DIM_PROFILE.keys:
        keyed = keyed.where(F.col(k).isNotNull())
    distinct = keyed.groupBy(*DIM_PROFILE.keys).agg(F.max("_batch_id").alias("_batch_id"))
    return _finish(distinct, DIM_PROFILE, batch_id, as_of)


def period_parts(df: DataFrame, month_column: str = "id_cmpt_movel") -> DataFrame:
    """Year, month, first-of-month date and 'yyyy-MM' label of a YYYYMM string."""
    month = F.col(month_column)
    first_day = F.try_to_date(F.concat(month, F.lit("01")), "yyyyMMdd")
    return df.withColumns(
        {
            "ano_competencia": F.substring(month, 1, 4).try_cast("int"),
            "mes_competencia": F.substring(month, 5, 2).try_cast("int"),
            "dt_competencia": first_day,
            "ds_competencia": F.date_format(first_day, "yyyy-MM"),
        }
    )


def fact_movement(silver_movement: DataFrame, batch_id=None, as_of=None) -> DataFrame:
    """Narrow projection: period parts + four recomputed surrogate keys + hash."""
    keyed = period_parts(silver_movement).withColumns(
        {spec.sk: hash_key(spec.keys, spec.namespace) for spec in (DIM_INSURER, DIM_MUNICIPALITY, DIM_PLAN, DIM_PROFILE)}
    )
    hashed = add_record_hash(keyed.select(*FACT_PAYLOAD, "_batch_id"), FACT_PAYLOAD)
    return add_gold_metadata(hashed, batch_id=batch_id, as_of=as_of).select(*FACT_PAYLOAD, *GOLD_META)
