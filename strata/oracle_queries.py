"""DuckDB oracle statements keyed like ``strata.queries.queries()``."""

from __future__ import annotations

from strata.oracle import with_ctes

_S3 = """CAST(sum(qt_beneficiario_ativo) AS BIGINT) AS beneficiarios_ativos,
       CAST(sum(qt_beneficiario_aderido) AS BIGINT) AS beneficiarios_aderidos,
       CAST(sum(qt_beneficiario_cancelado) AS BIGINT) AS beneficiarios_cancelados"""
_NET = "CAST(sum(qt_beneficiario_aderido) - sum(qt_beneficiario_cancelado) AS BIGINT) AS saldo_movimento"
_A1 = "CAST(sum(qt_beneficiario_ativo) AS BIGINT) AS beneficiarios_ativos"

ORACLE: dict[str, str] = {
    "available_periods": with_ctes(f"""
SELECT id_cmpt_movel, ds_competencia, {_S3}
FROM fact GROUP BY id_cmpt_movel, ds_competencia ORDER BY id_cmpt_movel DESC"""),
    "latest_summary": with_ctes(f"""
SELECT id_cmpt_movel, ds_competencia, count(*) AS linhas_fato, {_S3}, {_NET}
FROM latest GROUP BY id_cmpt_movel, ds_competencia"""),
    "active_by_state": with_ctes(f"""
SELECT m.sg_uf, {_S3}
FROM latest f JOIN d_municipality m ON f.sk_municipio = m.sk_municipio
GROUP BY m.sg_uf ORDER BY beneficiarios_ativos DESC NULLS LAST, m.sg_uf"""),
    "top_insurers": with_ctes(f"""
SELECT o.cd_operadora, o.nm_razao_social, o.modalidade_operadora, {_S3}
FROM latest f JOIN d_insurer o ON f.sk_operadora = o.sk_operadora
GROUP BY o.cd_operadora, o.nm_razao_social, o.modalidade_operadora
ORDER BY beneficiarios_ativos DESC NULLS LAST, o.cd_operadora, o.nm_razao_social, o.modalidade_operadora
LIMIT 20"""),
    "profile_sex_age": with_ctes(f"""
SELECT p.tp_sexo, p.de_faixa_etaria, {_A1}
FROM latest f JOIN d_profile p ON f.sk_perfil_beneficiario = p.sk_perfil_beneficiario
GROUP BY p.tp_sexo, p.de_faixa_etaria ORDER BY p.tp_sexo, p.de_faixa_etaria"""),
    "by_relationship": with_ctes(f"""
SELECT p.tipo_vinculo, {_S3}
FROM latest f JOIN d_profile p ON f.sk_perfil_beneficiario = p.sk_perfil_beneficiario
GROUP BY p.tipo_vinculo ORDER BY beneficiarios_ativos DESC NULLS LAST"""),
    "monthly_evolution": with_ctes(f"""
SELECT id_cmpt_movel, ds_competencia, {_S3}, {_NET}
FROM fact GROUP BY id_cmpt_movel, ds_competencia ORDER BY id_cmpt_movel"""),
    "plan_distribution": with_ctes(f"""
SELECT pl.de_contratacao_plano, pl.de_segmentacao_plano, {_A1}
FROM latest f JOIN d_plan pl ON f.sk_plano = pl.sk_plano
GROUP BY pl.de_contratacao_plano, pl.de_segmentacao_plano ORDER BY beneficiarios_ativos DESC NULLS LAST"""),
    "top_municipalities": with_ctes(f"""
SELECT m.sg_uf, m.nm_municipio, {_A1}
FROM latest f JOIN d_municipality m ON f.sk_municipio = m.sk_municipio
GROUP BY m.sg_uf, m.nm_municipio
ORDER BY beneficiarios_ativos DESC NULLS LAST, m.sg_uf, m.nm_municipio
LIMIT 50"""),
    "batch_audit": with_ctes("""
SELECT _batch_id, count(*) AS linhas, count(DISTINCT _source_path) AS arquivos
FROM bronze GROUP BY _batch_id ORDER BY _batch_id DESC LIMIT 10"""),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ---------------------------------------------------------------- everything else
from strata.oracle import (  # noqa: E402
    _RULES, ALL_CTES, AS_OF, cs, cu, digits, entity_body, in_list, khash, lit, pdate, plong, rhash,
)
from strata.oracle_values import (  # noqa: E402
    BUSINESS_COLUMNS, CLEAN_STRING_COLUMNS, CLEAN_UPPER_COLUMNS, COUNT_COLUMNS, DIGIT_COLUMNS, DIM_INSURER, DIM_MUNICIPALITY,
    DIM_PLAN, DIM_PROFILE, LEDGER_LAST_BATCH, MOVEMENT, MOVEMENT_KEY, PERIOD_COLUMNS, PERIOD_RANGE, PLAN, RULE_NAMES,
    SLICE_BATCH, VALID_UFS,
)

TS = {"_ingested_at", "_bronze_ingested_at", "_rejected_at", "_gold_ingested_at"}
CLEANED_COLUMNS = BUSINESS_COLUMNS + ["_source_path", "_bronze_record_hash", "_bronze_ingested_at",
                                      "_source_system", "_batch_id", "_ingested_at", "_layer"]
BRONZE_OUT = BUSINESS_COLUMNS + ["_source_path", "_source_system", "_batch_id", "_ingested_at", "_layer",
                                 "_record_hash"]
SILVER_ENTITY_COLUMNS = {
    "s_insurer": ["cd_operadora", "nm_razao_social", "nr_cnpj", "modalidade_operadora"],
    "s_municipality": ["cd_municipio", "nm_municipio", "sg_uf"],
    "s_plan": PLAN.columns[:7],
}
META = ["_source_system", "_batch_id", "_ingested_at", "_layer", "_record_hash"]
GOLD_META = ["_record_hash", "_batch_id", "_gold_ingested_at", "_layer"]


def sel(columns: list[str], prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{c} AS VARCHAR) AS {c}" if c in TS else f"{prefix}{c}" for c in columns)


def outputs(fn, columns: list[str], source: str = "bronze") -> str:
    return with_ctes(f"SELECT {', '.join(columns)}, {', '.join(f'{fn(c)} AS {c}_out' for c in columns)} FROM {source}")


def _dim_cols(spec) -> list[str]:
    return [spec.sk] + spec.columns + GOLD_META


MOVEMENT_OUT = MOVEMENT.columns + ["_record_hash"]
REJECTED_OUT = (MOVEMENT_KEY + ["_source_path", "_bronze_record_hash", "_bronze_ingested_at", "_source_system",
                                "_batch_id", "_ingested_at", "_layer", "_rejection_reason", "_rejected_at",
                                "_record_hash"])
FACT_OUT = PERIOD_COLUMNS + ["sk_operadora", "sk_municipio", "sk_plano", "sk_perfil_beneficiario"] + COUNT_COLUMNS + GOLD_META

_MERGE_JOIN = """m_target t FULL OUTER JOIN m_source s
    ON t.cd_operadora IS NOT DISTINCT FROM s.cd_operadora AND t.cd_plano IS NOT DISTINCT FROM s.cd_plano"""
_MERGE_CTES = f"""
m_target AS (
    SELECT *, true AS __t
    FROM ({entity_body(PLAN, f"(SELECT * FROM valid WHERE _batch_id < (SELECT max(_batch_id) FROM valid))")})
),
m_source0 AS ({entity_body(PLAN, f"(SELECT * FROM valid WHERE _batch_id = (SELECT max(_batch_id) FROM valid))")}),
m_source1 AS (
    SELECT * REPLACE (CASE WHEN TRY_CAST(cd_plano AS BIGINT) % 5 = 0 THEN 'ODONTOLOGICO' ELSE cobertura_assist_plan END
                      AS cobertura_assist_plan)
    FROM m_source0
),
m_source AS (SELECT * REPLACE ({rhash(PLAN.hash_columns)} AS _record_hash), true AS __s FROM m_source1)"""


def _merge_sql(insert_only: bool) -> str:
    """Insert new keys; update matched keys whose hash differs (unless insert-only); keep the rest."""
    take_source = "(t.__t IS NULL OR (s.__s IS NOT NULL AND coalesce(t._record_hash <> s._record_hash, false)))"
    out = []
    for c in PLAN.columns + ["_record_hash"]:
        if c in PLAN.keys or insert_only:
            expr = f"CASE WHEN t.__t IS NOT NULL THEN t.{c} ELSE s.{c} END"
        else:
            expr = f"CASE WHEN {take_source} THEN s.{c} ELSE t.{c} END"
        out.append(f"CAST({expr} AS VARCHAR) AS {c}" if c in TS else f"{expr} AS {c}")
    return with_ctes(f"SELECT {', '.join(out)} FROM {_MERGE_JOIN}", ctes=ALL_CTES + "," + _MERGE_CTES)


_REPLACE = f"""
SELECT {sel(MOVEMENT_OUT)} FROM s_movement
WHERE id_cmpt_movel NOT IN (SELECT id_cmpt_movel FROM r_months)
UNION ALL
SELECT {sel(MOVEMENT_OUT)} FROM (
    SELECT * REPLACE ({rhash(MOVEMENT.hash_columns)} AS _record_hash) FROM (
        SELECT * REPLACE (qt_beneficiario_ativo + 1 AS qt_beneficiario_ativo)
        FROM s_movement WHERE id_cmpt_movel IN (SELECT id_cmpt_movel FROM r_months)))"""

_DIR_LINKS = "(SELECT regexp_extract(_source_path, '^(.*/)', 1) AS link FROM bronze)"


def _period_of(x: str) -> str:
    last = f"regexp_extract(regexp_replace({x}, '/+$', ''), '([^/]*)$', 1)"
    return f"CASE WHEN regexp_full_match({last}, '[0-9]{{6}}') THEN {last} END"


_PERIODS = f"(SELECT DISTINCT {_period_of('link')} AS period FROM {_DIR_LINKS} WHERE {_period_of('link')} IS NOT NULL)"
# the last href of each tag, in any of its spellings, with the references that the pages use
_HREFS = """(SELECT page_id, replace(replace(replace(replace(replace(raw, '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS href
    FROM (SELECT page_id, concat_ws('',
            nullif(regexp_extract(tag, '(?is)^<a\\s.*\\bhref\\s*=\\s*"([^"]*)"', 1), ''),
            nullif(regexp_extract(tag, '(?is)^<a\\s.*\\bhref\\s*=\\s*''([^'']*)''', 1), ''),
            nullif(regexp_extract(tag, '(?is)^<a\\s.*\\bhref\\s*=\\s*([^\\s"''>]+)', 1), '')) AS raw
          FROM (SELECT page_id, unnest(regexp_extract_all(
                  regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'),
                  '(?is)<a\\s(?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag FROM pages)))"""
_PAGE_FILES = f"""(SELECT DISTINCT page_id, regexp_extract(href, '([^/]*)$', 1) AS file_name FROM {_HREFS}
    WHERE href <> '' AND NOT ends_with(href, '/') AND regexp_extract(href, '([^/]*)$', 1) <> '')"""

ORACLE.update({
    "clean_string": outputs(cs, CLEAN_STRING_COLUMNS),
    "clean_upper": outputs(cu, CLEAN_UPPER_COLUMNS),
    "only_digits": outputs(digits, DIGIT_COLUMNS),
    "parse_long": outputs(plong, COUNT_COLUMNS),
    "parse_date": outputs(pdate, ["dt_carga"]),
    "domain_nullout": with_ctes(
        f"SELECT sg_uf, CASE WHEN {cu('sg_uf')} IN ({in_list(VALID_UFS)}) THEN {cu('sg_uf')} END AS sg_uf_out FROM bronze"),
    "record_hash": with_ctes("SELECT _source_path, _batch_id, _record_hash FROM bronze"),
    "surrogate_key": with_ctes(
        "SELECT cd_operadora, cd_municipio, cd_plano, "
        + ", ".join(f"{khash(s.keys, s.namespace)} AS {s.sk}" for s in (DIM_INSURER, DIM_MUNICIPALITY, DIM_PLAN, DIM_PROFILE))
        + " FROM valid"),
    "normalized_columns": with_ctes(f"SELECT {', '.join(BUSINESS_COLUMNS)} FROM raw_movement"),
    "all_string_cast": with_ctes(
        f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in MOVEMENT_OUT)} FROM s_movement"),
    "bronze_metadata": with_ctes(f"SELECT {sel(BRONZE_OUT)} FROM bronze"),
    "batch_slice": with_ctes(f"SELECT {sel(BRONZE_OUT)} FROM bronze WHERE _batch_id = '{SLICE_BATCH}'"),
    "silver_metadata": with_ctes(
        f"SELECT {sel(['_source_path', '_source_system', '_batch_id', '_ingested_at', '_layer'])} FROM cleaned"),
    "gold_metadata": with_ctes(f"SELECT {sel(GOLD_META)} FROM fact"),
    "period_parts": with_ctes(f"SELECT {', '.join(PERIOD_COLUMNS)} FROM fact"),
    "clean_movement": with_ctes(f"SELECT {sel(CLEANED_COLUMNS)} FROM cleaned"),
    "null_condition": with_ctes(
        f"SELECT {', '.join(MOVEMENT_KEY)}, ({' OR '.join(f'{k} IS NULL' for k in MOVEMENT_KEY)}) AS missing_key FROM cleaned"),
    "rejection_reason": with_ctes(
        f"SELECT {', '.join(MOVEMENT_KEY)}, NULLIF(concat_ws('; ', "
        + ", ".join(f"CASE WHEN {k} IS NULL THEN {lit(k + ' ausente')} END" for k in MOVEMENT_KEY)
        + "), '') AS missing_reason FROM cleaned"),
    "rule_counts": with_ctes(
        "SELECT count(*) AS rows, "
        f"count(*) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in MOVEMENT_KEY)}) AS missing_key, "
        + ", ".join(f"count(*) FILTER (WHERE {cond}) AS {name}" for (cond, _), name in zip(_RULES, RULE_NAMES))
        + ", count(*) FILTER (WHERE _rejection_reason IS NOT NULL) AS rejected FROM classified"),
    "rejected_rows": with_ctes(
        f"SELECT {sel(CLEANED_COLUMNS + ['_rejection_reason'])}, '{AS_OF}' AS _rejected_at FROM classified "
        "WHERE _rejection_reason IS NOT NULL"),
    "valid_rows": with_ctes(f"SELECT {sel(CLEANED_COLUMNS)} FROM valid"),
    "reject_reason_counts": with_ctes(
        "SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(_rejection_reason, '; ')) AS reason "
        "FROM classified WHERE _rejection_reason IS NOT NULL) GROUP BY reason"),
    "new_files_only": with_ctes(
        f"SELECT {', '.join(BUSINESS_COLUMNS)}, _source_path, _batch_id, _record_hash FROM bronze "
        f"ANTI JOIN (SELECT DISTINCT _source_path FROM bronze WHERE _batch_id <= '{LEDGER_LAST_BATCH}') USING (_source_path)"),
    "load_counters": with_ctes(
        "SELECT count(DISTINCT _source_path) AS files_written, count(*) AS rows_written FROM bronze "
        f"ANTI JOIN (SELECT DISTINCT _source_path FROM bronze WHERE _batch_id <= '{LEDGER_LAST_BATCH}') USING (_source_path)"),
    "latest_period": with_ctes(f"SELECT {sel(FACT_OUT)} FROM latest"),
    "first_not_null": with_ctes(
        "SELECT cd_operadora, "
        + ", ".join(f"arg_min({c}, _bronze_record_hash) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                    for c in ("nm_razao_social", "nr_cnpj", "modalidade_operadora"))
        + " FROM cleaned GROUP BY cd_operadora"),
    "latest_batch": with_ctes("SELECT max(_batch_id) AS _batch_id FROM bronze WHERE _batch_id IS NOT NULL"),
    "dedupe_latest": with_ctes(
        f"SELECT {sel(CLEANED_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(MOVEMENT_KEY)} "
        "ORDER BY dt_carga DESC NULLS LAST, _bronze_ingested_at DESC NULLS LAST, _source_path DESC NULLS LAST, "
        "_bronze_record_hash DESC NULLS LAST) AS rn FROM cleaned) WHERE rn = 1"),
    "silver_insurer": with_ctes(f"SELECT {sel(SILVER_ENTITY_COLUMNS['s_insurer'] + META)} FROM s_insurer"),
    "silver_municipality": with_ctes(f"SELECT {sel(SILVER_ENTITY_COLUMNS['s_municipality'] + META)} FROM s_municipality"),
    "silver_plan": with_ctes(f"SELECT {sel(SILVER_ENTITY_COLUMNS['s_plan'] + META)} FROM s_plan"),
    "silver_movement": with_ctes(f"SELECT {sel(MOVEMENT_OUT)} FROM s_movement"),
    "silver_rejected": with_ctes(f"SELECT {sel(REJECTED_OUT)} FROM rejected"),
    "dim_insurer": with_ctes(f"SELECT {sel(_dim_cols(DIM_INSURER))} FROM d_insurer"),
    "dim_municipality": with_ctes(f"SELECT {sel(_dim_cols(DIM_MUNICIPALITY))} FROM d_municipality"),
    "dim_plan": with_ctes(f"SELECT {sel(_dim_cols(DIM_PLAN))} FROM d_plan"),
    "dim_profile": with_ctes(f"SELECT {sel(_dim_cols(DIM_PROFILE))} FROM d_profile"),
    "fact_movement": with_ctes(f"SELECT {sel(FACT_OUT)} FROM fact"),
    "scd1_merge": _merge_sql(False),
    "scd1_merge_insert_only": _merge_sql(True),
    "change_feed": with_ctes(
        f"SELECT {sel(PLAN.columns + ['_record_hash'], 's.')} FROM m_source s WHERE NOT EXISTS (SELECT 1 FROM m_target t "
        "WHERE t.cd_operadora IS NOT DISTINCT FROM s.cd_operadora AND t.cd_plano IS NOT DISTINCT FROM s.cd_plano "
        "AND coalesce(t._record_hash = s._record_hash, true))", ctes=ALL_CTES + "," + _MERGE_CTES),
    "partition_replace": with_ctes(_REPLACE, ctes=ALL_CTES + ", r_months AS (SELECT DISTINCT id_cmpt_movel FROM s_movement "
                                   "ORDER BY id_cmpt_movel DESC LIMIT 2)"),
    "page_file_links": f"SELECT * FROM {_PAGE_FILES}",
    "periods_in_range": with_ctes(
        f"SELECT period FROM {_PERIODS} WHERE period >= '{PERIOD_RANGE[0]}' AND period <= '{PERIOD_RANGE[1]}'"),
    "latest_source_period": with_ctes(f"SELECT max(period) AS period FROM {_PERIODS} HAVING max(period) IS NOT NULL"),
    "unpublished_periods": with_ctes(
        f"SELECT period FROM {_PERIODS} WHERE period NOT IN (SELECT id_cmpt_movel FROM s_movement "
        f"WHERE _batch_id <= '{LEDGER_LAST_BATCH}')"),
    "allowed_files": with_ctes(
        f"SELECT DISTINCT file_name FROM (SELECT file_name FROM {_PAGE_FILES} UNION ALL "
        "SELECT regexp_extract(_source_path, '([^/]*)$', 1) FROM bronze) "
        "WHERE ends_with(lower(file_name), '.csv') AND NOT contains(upper(file_name), 'PART-3')"),
    "csv_scan": with_ctes(f"SELECT {', '.join(BUSINESS_COLUMNS)} FROM raw_movement"),
    "malformed_lines": with_ctes(
        "SELECT linha, count(*) AS vezes FROM (SELECT CASE right(cd_plano, 1) WHEN '7' THEN concat_ws(';', "
        + ", ".join(f"coalesce({c}, '')" for c in BUSINESS_COLUMNS)
        + ", 'x') WHEN '3' THEN concat_ws(';', "
        + ", ".join(f"coalesce({c}, '')" for c in BUSINESS_COLUMNS[:-1])
        + ") END AS linha FROM raw_movement) WHERE linha IS NOT NULL GROUP BY linha"),
})
