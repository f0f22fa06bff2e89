"""Silver layer: clean, validate, quarantine and deduplicate bronze movement rows
into four entities (insurer, municipality, plan, movement) and a reject table.

Everything is one declarative plan per output.  ``load_silver`` stages the
classified rows once, so that the bronze scan and the cleaning projection are
not repeated for each of the five outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import clean_string, clean_upper, in_domain, only_digits, parse_date, parse_long
from strata.functions.constants import VALID_UFS
from strata.functions.hashing import add_record_hash, record_hash
from strata.operators.dedupe import latest_per_key
from strata.operators.lineage import add_silver_metadata
from strata.operators.quality import Rule, classify, rejected_part, require_columns, valid_part

# --- fixed values: the columns of the data contract --------------------------
BRONZE_COLUMNS = [
    "_record_hash",
    "_batch_id",
    "id_cmpt_movel",
    "cd_operadora",
    "nm_razao_social",
    "nr_cnpj",
    "modalidade_operadora",
    "sg_uf",
    "cd_municipio",
    "nm_municipio",
    "tp_sexo",
    "de_faixa_etaria",
    "de_faixa_etaria_reaj",
    "cd_plano",
    "tp_vigencia_plano",
    "de_contratacao_plano",
    "de_segmentacao_plano",
    "de_abrg_geografica_plano",
    "cobertura_assist_plan",
    "tipo_vinculo",
    "qt_beneficiario_ativo",
    "qt_beneficiario_aderido",
    "qt_beneficiario_cancelado",
    "dt_carga",
    "_source_path",
    "_ingested_at",
    "_source_system",
]

MOVEMENT_KEY = [
    "id_cmpt_movel",
    "cd_operadora",
    "cd_municipio",
    "cd_plano",
    "tp_sexo",
    "de_faixa_etaria",
    "de_faixa_etaria_reaj",
    "tipo_vinculo",
]

DEDUPE_ORDER = ["dt_carga", "_bronze_ingested_at", "_source_path", "_bronze_record_hash"]

COUNT_COLUMNS = ["qt_beneficiario_ativo", "qt_beneficiario_aderido", "qt_beneficiario_cancelado"]
# --- end of fixed values ----------------------------------------------------

#: The columns of a raw file, in the order in which the record hash reads them.
RAW_COLUMNS = [c for c in BRONZE_COLUMNS if not c.startswith("_")]

# --- fixed values: rejection reasons recorded in _rejection_reason ----------
REASON_MONTH_FORMAT = "id_cmpt_movel fora do formato YYYYMM"
REASON_MONTH_VALUE = "id_cmpt_movel com mes invalido"
REASON_INSURER = "cd_operadora deve conter apenas digitos"
REASON_MUNICIPALITY = "cd_municipio fora do formato esperado"
REASON_STATE = "sg_uf ausente ou invalida"
REASON_SEX = "tp_sexo fora do dominio esperado"
REASON_TAX_ID = "nr_cnpj deve conter 14 digitos"
REASON_NEGATIVE = "{} negativa"
REASON_DATE = "dt_carga ausente ou invalida"
SEX_DOMAIN = ["F", "M", "I"]
# --- end of fixed values ----------------------------------------------------


def clean_movement(bronze: DataFrame, batch_id: str | None = None, as_of=None) -> DataFrame:
    """One projection from bronze strings to typed, cleaned silver columns."""
    require_columns(bronze, BRONZE_COLUMNS)
    cleaned = bronze.select(
        only_digits("id_cmpt_movel").alias("id_cmpt_movel"),
        clean_string("cd_operadora").alias("cd_operadora"),
        clean_upper("nm_razao_social").alias("nm_razao_social"),
        only_digits("nr_cnpj").alias("nr_cnpj"),
        clean_upper("modalidade_operadora").alias("modalidade_operadora"),
        in_domain(clean_upper("sg_uf"), VALID_UFS).alias("sg_uf"),
        clean_string("cd_municipio").alias("cd_municipio"),
        clean_upper("nm_municipio").alias("nm_municipio"),
        clean_upper("tp_sexo").alias("tp_sexo"),
        clean_string("de_faixa_etaria").alias("de_faixa_etaria"),
        clean_string("de_faixa_etaria_reaj").alias("de_faixa_etaria_reaj"),
        clean_string("cd_plano").alias("cd_plano"),
        clean_upper("tp_vigencia_plano").alias("tp_vigencia_plano"),
        clean_upper("de_contratacao_plano").alias("de_contratacao_plano"),
        clean_upper("de_segmentacao_plano").alias("de_segmentacao_plano"),
        clean_upper("de_abrg_geografica_plano").alias("de_abrg_geografica_plano"),
        clean_upper("cobertura_assist_plan").alias("cobertura_assist_plan"),
        clean_upper("tipo_vinculo").alias("tipo_vinculo"),
        *[parse_long(c).alias(c) for c in COUNT_COLUMNS],
        parse_date("dt_carga").alias("dt_carga"),
        clean_string("_source_path").alias("_source_path"),
        clean_string("_record_hash").alias("_bronze_record_hash"),
        F.col("_ingested_at").cast("timestamp").alias("_bronze_ingested_at"),
        clean_upper("_source_system").alias("_source_system"),
        clean_string("_batch_id").alias("_batch_id"),
    )
    return add_silver_metadata(cleaned, batch_id=batch_id, as_of=as_of)


def month_rules() -> list[Rule]:
    month = F.col("id_cmpt_movel")
    six_digits = month.rlike(r"^[0-9]{6}$")
    return [
        Rule(month.isNotNull() & ~six_digits, REASON_MONTH_FORMAT),
        Rule(six_digits & ~F.substring(month, 5, 2).try_cast("int").between(1, 12), REASON_MONTH_VALUE),
    ]


def movement_rules() -> list[Rule]:
    rules = month_rules() + [
        Rule(F.col("cd_operadora").isNotNull() & ~F.col("cd_operadora").rlike(r"^[0-9]+$"), REASON_INSURER),
        Rule(
            F.col("cd_municipio").isNotNull() & ~F.col("cd_municipio").rlike(r"^[0-9]{6,7}$"),
            REASON_MUNICIPALITY,
        ),
        Rule(F.col("sg_uf").isNull(), REASON_STATE),
        Rule(F.col("tp_sexo").isNotNull() & ~F.col("tp_sexo").isin(SEX_DOMAIN), REASON_SEX),
        Rule(F.col("nr_cnpj").isNotNull() & (F.length("nr_cnpj") != 14), REASON_TAX_ID),
    ]
    rules += [Rule(F.col(c).isNotNull() & (F.col(c) < 0), REASON_NEGATIVE.format(c)) for c in COUNT_COLUMNS]
    rules.append(Rule(F.col("dt_carga").isNull(), REASON_DATE))
    return rules


RULE_NAMES = [
    "month_format",
    "month_value",
    "insurer_code",
    "municipality_code",
    "state",
    "sex",
    "tax_id",
    "negative_active",
    "negative_joined",
    "negative_cancelled",
    "load_date",
]


def classify_movement(cleaned: DataFrame) -> DataFrame:
    """Adds ``_rejection_reason`` (NULL for a valid row)."""
    return classify(cleaned, MOVEMENT_KEY, movement_rules())


@dataclass(frozen=True)
class EntitySpec:
    keys: list[str]
    columns: list[str]
    hash_columns: list[str]


SILVER_META = ["_source_system", "_batch_id", "_ingested_at", "_layer"]

INSURER = EntitySpec(
    keys=["cd_operadora"],
    columns=["cd_operadora", "nm_razao_social", "nr_cnpj", "modalidade_operadora"] + SILVER_META,
    hash_columns=["cd_operadora", "nm_razao_social", "nr_cnpj", "modalidade_operadora", "_source_system"],
)
MUNICIPALITY = EntitySpec(
    keys=["cd_municipio"],
    columns=["cd_municipio", "nm_municipio", "sg_uf"] + SILVER_META,
    hash_columns=["cd_municipio", "nm_municipio", "sg_uf", "_source_system"],
)
PLAN_ATTRIBUTES = [
    "tp_vigencia_plano",
    "de_contratacao_plano",
    "de_segmentacao_plano",
    "de_abrg_geografica_plano",
    "cobertura_assist_plan",
]
PLAN = EntitySpec(
    keys=["cd_operadora", "cd_plano"],
    columns=["cd_operadora", "cd_plano"] + PLAN_ATTRIBUTES + SILVER_META,
    hash_columns=["cd_operadora", "cd_plano"] + PLAN_ATTRIBUTES + ["_source_system"],
)
MOVEMENT = EntitySpec(
    keys=MOVEMENT_KEY,
    columns=MOVEMENT_KEY
    + COUNT_COLUMNS
    + ["dt_carga", "_source_path", "_bronze_record_hash", "_bronze_ingested_at"]
    + SILVER_META,
    hash_columns=MOVEMENT_KEY + COUNT_COLUMNS + ["dt_carga", "_source_system"],
)
REJECTED_COLUMNS = (
    MOVEMENT_KEY
    + ["_source_path", "_bronze_record_hash", "_bronze_ingested_at"]
    + SILVER_META
    + ["_rejection_reason", "_rejected_at"]
)
REJECTED_HASH = MOVEMENT_KEY + ["_bronze_record_hash", "_rejection_reason"]


def build_entity(valid: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows with a full key -> latest row per key -> entity columns -> record hash."""
    keyed = valid
    for k in spec.keys:
        keyed = keyed.where(F.col(k).isNotNull())
    # not null by schema too, so that a merge matches by plain equality and leaves the rows where the window has them
    keyed = keyed.withColumns({k: F.coalesce(k, F.lit("")) for k in spec.keys})
    latest = latest_per_key(keyed, spec.keys, DEDUPE_ORDER, digest="_bronze_record_hash")
    return add_record_hash(latest.select(*spec.columns), spec.hash_columns)


def silver_insurer(valid: DataFrame) -> DataFrame:
    return build_entity(valid, INSURER)


def silver_municipality(valid: DataFrame) -> DataFrame:
    return build_entity(valid, MUNICIPALITY)


def silver_plan(valid: DataFrame) -> DataFrame:
    return build_entity(valid, PLAN)


def silver_movement(valid: DataFrame) -> DataFrame:
    # Every key column is already non-null in a valid row (a NULL key rejects it).  The month
    # travels apart, as readers filter on it; the other keys are needed here, whatever is read.
    latest = latest_per_key(valid, MOVEMENT.keys, DEDUPE_ORDER, digest="_bronze_record_hash", packed=MOVEMENT.keys[1:])
    return add_record_hash(latest.select(*MOVEMENT.columns), MOVEMENT.hash_columns)


def silver_rejected(classified: DataFrame, as_of=None) -> DataFrame:
    rejected = rejected_part(classified, as_of=as_of).select(*REJECTED_COLUMNS)
    return add_record_hash(rejected, REJECTED_HASH)


def valid_movement(classified: DataFrame) -> DataFrame:
    return valid_part(classified)
