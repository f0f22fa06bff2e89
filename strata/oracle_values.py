"""The lists and literals of the oracle's SQL, written out from the contract.

Nothing here comes from the code under test: a wrong list there shows as a mismatch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# what a cell may say for "absent", trimmed and in upper case
NULL_TOKENS = ["", "NULL", "N/A", "NA", "NAN", "-", "NONE"]

# state codes
VALID_UFS = "AC AL AP AM BA CE DF ES GO MA MT MS MG PA PB PR PE PI RJ RN RS RO RR SC SP SE TO".split()

# the raw file's columns, in the record hash's order
BUSINESS_COLUMNS = """
    id_cmpt_movel cd_operadora nm_razao_social nr_cnpj modalidade_operadora sg_uf cd_municipio nm_municipio
    tp_sexo de_faixa_etaria de_faixa_etaria_reaj cd_plano tp_vigencia_plano de_contratacao_plano
    de_segmentacao_plano de_abrg_geografica_plano cobertura_assist_plan tipo_vinculo
    qt_beneficiario_ativo qt_beneficiario_aderido qt_beneficiario_cancelado dt_carga
""".split()

COUNT_COLUMNS = "qt_beneficiario_ativo qt_beneficiario_aderido qt_beneficiario_cancelado".split()

MOVEMENT_KEY = """
    id_cmpt_movel cd_operadora cd_municipio cd_plano tp_sexo de_faixa_etaria de_faixa_etaria_reaj tipo_vinculo
""".split()

PERIOD_COLUMNS = "id_cmpt_movel ano_competencia mes_competencia dt_competencia ds_competencia".split()

FACT_PAYLOAD = """
    id_cmpt_movel ano_competencia mes_competencia dt_competencia ds_competencia
    sk_operadora sk_municipio sk_plano sk_perfil_beneficiario
    qt_beneficiario_ativo qt_beneficiario_aderido qt_beneficiario_cancelado
""".split()

REJECTED_COLUMNS = """
    id_cmpt_movel cd_operadora cd_municipio cd_plano tp_sexo de_faixa_etaria de_faixa_etaria_reaj tipo_vinculo
    _source_path _bronze_record_hash _bronze_ingested_at _source_system _batch_id _ingested_at _layer
    _rejection_reason _rejected_at
""".split()

REJECTED_HASH = """
    id_cmpt_movel cd_operadora cd_municipio cd_plano tp_sexo de_faixa_etaria de_faixa_etaria_reaj tipo_vinculo
    _bronze_record_hash _rejection_reason
""".split()


@dataclass(frozen=True)
class Entity:
    keys: list[str]
    columns: list[str]
    hash_columns: list[str]


@dataclass(frozen=True)
class Dimension:
    sk: str
    namespace: str
    keys: list[str]
    attributes: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return self.keys + self.attributes


LOADED = "_source_system _batch_id _ingested_at _layer".split()


def _entity(keys: str, payload: str) -> Entity:
    return Entity(keys.split(), payload.split() + LOADED, payload.split() + ["_source_system"])


INSURER = _entity("cd_operadora", "cd_operadora nm_razao_social nr_cnpj modalidade_operadora")
MUNICIPALITY = _entity("cd_municipio", "cd_municipio nm_municipio sg_uf")
PLAN = _entity(
    "cd_operadora cd_plano",
    "cd_operadora cd_plano tp_vigencia_plano de_contratacao_plano de_segmentacao_plano de_abrg_geografica_plano cobertura_assist_plan",
)
MOVEMENT = Entity(
    MOVEMENT_KEY,
    [*MOVEMENT_KEY, *COUNT_COLUMNS, "dt_carga", "_source_path", "_bronze_record_hash", "_bronze_ingested_at", *LOADED],
    [*MOVEMENT_KEY, *COUNT_COLUMNS, "dt_carga", "_source_system"],
)

DIM_INSURER = Dimension("sk_operadora", "dim_operadora", ["cd_operadora"], ["nm_razao_social", "nr_cnpj", "modalidade_operadora"])
DIM_MUNICIPALITY = Dimension("sk_municipio", "dim_municipio", ["cd_municipio"], ["nm_municipio", "sg_uf"])
DIM_PLAN = Dimension(
    "sk_plano",
    "dim_plano",
    ["cd_operadora", "cd_plano"],
    "tp_vigencia_plano de_contratacao_plano de_segmentacao_plano de_abrg_geografica_plano cobertura_assist_plan".split(),
)
DIM_PROFILE = Dimension(
    "sk_perfil_beneficiario", "dim_perfil_beneficiario", ["tp_sexo", "de_faixa_etaria", "de_faixa_etaria_reaj", "tipo_vinculo"]
)
# --- end of fixed values ----------------------------------------------------

# --- what the registered queries are asked for ------------------------------
#: State of each nation of the fixture, by its number.
STATES = VALID_UFS[:25]

RULE_NAMES = """
    month_format month_value insurer_code municipality_code state sex tax_id
    negative_active negative_joined negative_cancelled load_date
""".split()

CLEAN_STRING_COLUMNS = """
    id_cmpt_movel cd_operadora cd_municipio cd_plano de_faixa_etaria modalidade_operadora tipo_vinculo cobertura_assist_plan
""".split()
CLEAN_UPPER_COLUMNS = "nm_razao_social modalidade_operadora sg_uf tp_sexo tipo_vinculo cobertura_assist_plan".split()
DIGIT_COLUMNS = ["id_cmpt_movel", "nr_cnpj", "cd_operadora"]
LEDGER_LAST_BATCH = "b1999"
PERIOD_RANGE = ("199601", "200012")
SLICE_BATCH = "b1998"
