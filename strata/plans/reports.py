"""Reports over the gold star schema.

Plan shape used throughout:
* The latest month is selected with a scalar subquery
  (``month = (SELECT max(month) ...)``), which the optimizer can turn into a
  partition filter on a month-partitioned fact table; a join to a one-row
  CTE could not prune.
* The fact is aggregated by surrogate key *before* joining a dimension, so
  the join sees at most one row per key instead of every fact row; partial
  aggregation runs before each shuffle, which also absorbs hot keys.
* The join itself is left to AQE: it broadcasts the pre-aggregated side at
  runtime when it is under the threshold and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: report column names ---------------------------------------
ACTIVE = "beneficiarios_ativos"
JOINED = "beneficiarios_aderidos"
CANCELLED = "beneficiarios_cancelados"
NET = "saldo_movimento"
FACT_ROWS = "linhas_fato"
AUDIT_ROWS = "linhas"
AUDIT_FILES = "arquivos"
# --- end of fixed values ----------------------------------------------------

MEASURES = {
    ACTIVE: "qt_beneficiario_ativo",
    JOINED: "qt_beneficiario_aderido",
    CANCELLED: "qt_beneficiario_cancelado",
}


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(MEASURES[n]).alias(n) for n in names]


def latest_period(
    fact: DataFrame, month_column: str = "id_cmpt_movel", months: DataFrame | None = None
) -> DataFrame:
    """Fact rows of the greatest month, via a scalar subquery.

    ``months`` has the fact's months, repeated or not, where less is to be done for them than for the fact.
    """
    latest = (fact if months is None else months).select(F.max(month_column)).scalar()
    return fact.where(F.col(month_column) == latest)


def _by_dimension(
    fact: DataFrame, dim: DataFrame, sk: str, groups: list[str], measures: list[str]
) -> DataFrame:
    per_key = fact.groupBy(sk).agg(*_sums(measures))
    joined = per_key.join(dim.select(sk, *groups), sk)
    return joined.groupBy(*groups).agg(*[F.sum(m).alias(m) for m in measures])


def available_periods(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("id_cmpt_movel", "ds_competencia")
        .agg(*_sums([ACTIVE, JOINED, CANCELLED]))
        .orderBy(F.col("id_cmpt_movel").desc())
    )


def latest_summary(fact: DataFrame, months: DataFrame | None = None) -> DataFrame:
    return (
        latest_period(fact, months=months)
        .groupBy("id_cmpt_movel", "ds_competencia")
        .agg(
            F.count(F.lit(1)).alias(FACT_ROWS),
            *_sums([ACTIVE, JOINED, CANCELLED]),
            (F.sum(MEASURES[JOINED]) - F.sum(MEASURES[CANCELLED])).alias(NET),
        )
    )


def active_by_state(fact: DataFrame, dim_municipality: DataFrame, months: DataFrame | None = None) -> DataFrame:
    return _by_dimension(
        latest_period(fact, months=months), dim_municipality, "sk_municipio", ["sg_uf"], [ACTIVE, JOINED, CANCELLED]
    ).orderBy(F.col(ACTIVE).desc(), F.col("sg_uf"))


def top_insurers(fact: DataFrame, dim_insurer: DataFrame, k: int = 20, months: DataFrame | None = None) -> DataFrame:
    groups = ["cd_operadora", "nm_razao_social", "modalidade_operadora"]
    return (
        _by_dimension(latest_period(fact, months=months), dim_insurer, "sk_operadora", groups, [ACTIVE, JOINED, CANCELLED])
        .orderBy(F.col(ACTIVE).desc(), *groups)
        .limit(k)
    )


def profile_sex_age(fact: DataFrame, dim_profile: DataFrame, months: DataFrame | None = None) -> DataFrame:
    return _by_dimension(
        latest_period(fact, months=months), dim_profile, "sk_perfil_beneficiario", ["tp_sexo", "de_faixa_etaria"], [ACTIVE]
    ).orderBy("tp_sexo", "de_faixa_etaria")


def by_relationship(fact: DataFrame, dim_profile: DataFrame, months: DataFrame | None = None) -> DataFrame:
    return _by_dimension(
        latest_period(fact, months=months), dim_profile, "sk_perfil_beneficiario", ["tipo_vinculo"], [ACTIVE, JOINED, CANCELLED]
    ).orderBy(F.col(ACTIVE).desc(), "tipo_vinculo")


def monthly_evolution(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("id_cmpt_movel", "ds_competencia")
        .agg(
            *_sums([ACTIVE, JOINED, CANCELLED]),
            (F.sum(MEASURES[JOINED]) - F.sum(MEASURES[CANCELLED])).alias(NET),
        )
        .orderBy("id_cmpt_movel")
    )


def plan_distribution(fact: DataFrame, dim_plan: DataFrame, months: DataFrame | None = None) -> DataFrame:
    groups = ["de_contratacao_plano", "de_segmentacao_plano"]
    return _by_dimension(latest_period(fact, months=months), dim_plan, "sk_plano", groups, [ACTIVE]).orderBy(
        F.col(ACTIVE).desc(), *groups
    )


def top_municipalities(fact: DataFrame, dim_municipality: DataFrame, k: int = 50, months: DataFrame | None = None) -> DataFrame:
    groups = ["sg_uf", "nm_municipio"]
    return (
        _by_dimension(latest_period(fact, months=months), dim_municipality, "sk_municipio", groups, [ACTIVE])
        .orderBy(F.col(ACTIVE).desc(), *groups)
        .limit(k)
    )


def batch_audit(bronze: DataFrame, k: int = 10) -> DataFrame:
    """Rows and distinct files per load batch, newest batches first."""
    return (
        bronze.groupBy("_batch_id")
        .agg(F.count(F.lit(1)).alias(AUDIT_ROWS), F.countDistinct("_source_path").alias(AUDIT_FILES))
        .orderBy(F.col("_batch_id").desc())
        .limit(k)
    )
