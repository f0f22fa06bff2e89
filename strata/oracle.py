"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written from the semantics, not generated from the Spark plans,
and its lists stand in ``strata.oracle_values``: nothing is imported from the code under test.  DuckDB differences handled here:
``trim(x, ' ')`` (plain ``trim`` also strips other whitespace),
``regexp_replace(..., 'g')``, ``try_strptime`` guarded by a layout regex
(it is more lenient than Spark), ``sum(bigint)`` cast back to BIGINT, and
timestamps compared as text.
"""

from __future__ import annotations

from strata.oracle_values import (
    BUSINESS_COLUMNS,
    DIM_INSURER,
    DIM_MUNICIPALITY,
    DIM_PLAN,
    DIM_PROFILE,
    FACT_PAYLOAD,
    INSURER,
    MOVEMENT,
    MOVEMENT_KEY,
    MUNICIPALITY,
    NULL_TOKENS,
    PLAN,
    REJECTED_COLUMNS,
    REJECTED_HASH,
    STATES,
    VALID_UFS,
)

AS_OF = "2026-01-01 00:00:00"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values: list[str]) -> str:
    return ", ".join(lit(v) for v in values)


def cs(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR), ' ')"
    return f"(CASE WHEN upper({t}) IN ({in_list(NULL_TOKENS)}) THEN NULL ELSE {t} END)"


def cu(x: str) -> str:
    return f"upper({cs(x)})"


def digits(x: str) -> str:
    return f"NULLIF(regexp_replace({cs(x)}, '[^0-9]', '', 'g'), '')"


def plong(x: str) -> str:
    v = f"regexp_replace({cs(x)}, '[^0-9-]', '', 'g')"
    return f"(CASE WHEN regexp_full_match({v}, '-?[0-9]+') THEN TRY_CAST({v} AS BIGINT) END)"


def pdate(x: str) -> str:
    v = cs(x)
    return (
        "coalesce("
        f"CASE WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN CAST(try_strptime({v}, '%Y-%m-%d') AS DATE) END, "
        f"CASE WHEN regexp_full_match({v}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN CAST(try_strptime({v}, '%d/%m/%Y') AS DATE) END, "
        f"CASE WHEN regexp_full_match({v}, '[0-9]{{8}}') THEN CAST(try_strptime({v}, '%Y%m%d') AS DATE) END)"
    )


def rhash(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def khash(cols: list[str], namespace: str) -> str:
    parts = ", ".join([lit(namespace)] + [f"coalesce(trim(CAST({c} AS VARCHAR), ' '), '__NULL__')" for c in cols])
    return f"sha256(concat_ws('||', {parts}))"


def ts_text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


# ---------------------------------------------------------------- raw + bronze
_K = "l_orderkey"
_YYYY = "substr(ym, 1, 4)"
_MM = "substr(ym, 5, 2)"
_QTY = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"

RAW_CTES = f"""
raw_rows AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus,
           o_orderpriority, c_nationkey, c_mktsegment, n_name, s_name, p_brand, p_type, p_size,
           CAST(year(l_shipdate) * 100 + month(l_shipdate) AS VARCHAR) AS ym
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN part ON l_partkey = p_partkey
),
raw_copies AS (
    SELECT *, false AS is_reload FROM raw_rows
    UNION ALL
    SELECT *, true AS is_reload FROM raw_rows WHERE l_orderkey % 53 = 0
),
raw_movement AS (
    SELECT
        CASE WHEN {_K} % 101 = 0 THEN {_YYYY} || '-13' WHEN {_K} % 103 = 0 THEN {_YYYY}
             WHEN {_K} % 107 = 0 THEN ' n/a ' ELSE {_YYYY} || '-' || {_MM} END AS id_cmpt_movel,
        CASE WHEN {_K} % 109 = 0 THEN 'OP' || CAST(l_suppkey AS VARCHAR)
             ELSE ' ' || CAST(l_suppkey AS VARCHAR) || ' ' END AS cd_operadora,
        ' ' || lower(s_name) || '  ' AS nm_razao_social,
        CASE WHEN {_K} % 97 = 0 THEN '123' ELSE lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || '/0001-00' END AS nr_cnpj,
        CASE WHEN l_suppkey % 3 = 0 THEN 'cooperativa' WHEN l_suppkey % 3 = 1 THEN 'seguradora' ELSE 'NULL' END
            AS modalidade_operadora,
        CASE WHEN {_K} % 89 = 0 THEN 'zz' ELSE lower([{in_list(STATES)}][c_nationkey + 1]) END AS sg_uf,
        CASE WHEN {_K} % 83 = 0 THEN '12' ELSE CAST(100000 + c_nationkey AS VARCHAR) END AS cd_municipio,
        lower(n_name) AS nm_municipio,
        CASE WHEN {_K} % 79 = 0 THEN 'x' WHEN l_returnflag = 'A' THEN 'f' WHEN l_returnflag = 'N' THEN 'M'
             ELSE ' i' END AS tp_sexo,
        c_mktsegment AS de_faixa_etaria,
        o_orderpriority AS de_faixa_etaria_reaj,
        CAST(l_partkey AS VARCHAR) AS cd_plano,
        CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'p' END AS tp_vigencia_plano,
        p_brand AS de_contratacao_plano,
        p_type AS de_segmentacao_plano,
        CASE WHEN l_suppkey % 2 = 0 THEN 'nacional' ELSE 'estadual' END AS de_abrg_geografica_plano,
        CASE WHEN p_size % 5 = 0 THEN '-' ELSE 'medico' END AS cobertura_assist_plan,
        CASE WHEN {_K} % 73 = 0 THEN 'None' WHEN l_linestatus = 'O' THEN 'titular' ELSE 'dependente' END AS tipo_vinculo,
        CASE WHEN {_K} % 71 = 0 THEN '-' || {_QTY} WHEN {_K} % 7 = 0 THEN 'abc' ELSE {_QTY} || ' ' END
            AS qt_beneficiario_ativo,
        CASE WHEN is_reload THEN CAST(l_linenumber + 1 AS VARCHAR) ELSE CAST(l_linenumber AS VARCHAR) END
            AS qt_beneficiario_aderido,
        CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS VARCHAR) ELSE '0' END AS qt_beneficiario_cancelado,
        CASE WHEN is_reload THEN {_YYYY} || '-' || {_MM} || '-20'
             WHEN {_K} % 67 = 0 THEN 'sem data'
             WHEN {_K} % 3 = 0 THEN {_YYYY} || '-' || {_MM} || '-05'
             WHEN {_K} % 3 = 1 THEN '06/' || {_MM} || '/' || {_YYYY}
             ELSE {_YYYY} || {_MM} || '07' END AS dt_carga,
        CASE WHEN is_reload THEN 'raw/reload/' ELSE 'raw/' END || ym || '/part-' || CAST({_K} % 4 AS VARCHAR) || '.csv'
            AS _source_path,
        'b' || {_YYYY} AS _batch_id,
        CAST(CAST(CAST({_YYYY} AS INTEGER) + 1 AS VARCHAR)
             || CASE WHEN is_reload THEN '-02-15 00:00:00' ELSE '-01-15 00:00:00' END AS TIMESTAMP) AS _ingested_at
    FROM raw_copies
),
bronze AS (
    SELECT {cols(BUSINESS_COLUMNS)}, _source_path, 'ANS' AS _source_system, _batch_id, _ingested_at,
           'bronze' AS _layer, {rhash(BUSINESS_COLUMNS)} AS _record_hash
    FROM raw_movement
)"""

# ---------------------------------------------------------------- silver
_UPPER = {
    "nm_razao_social", "modalidade_operadora", "nm_municipio", "tp_sexo", "tp_vigencia_plano",
    "de_contratacao_plano", "de_segmentacao_plano", "de_abrg_geografica_plano", "cobertura_assist_plan",
    "tipo_vinculo",
}


def _clean_expr(c: str) -> str:
    if c in ("id_cmpt_movel", "nr_cnpj"):
        return digits(c)
    if c == "sg_uf":
        return f"CASE WHEN {cu(c)} IN ({in_list(VALID_UFS)}) THEN {cu(c)} END"
    if c in _UPPER:
        return cu(c)
    if c.startswith("qt_"):
        return plong(c)
    if c == "dt_carga":
        return pdate(c)
    return cs(c)


_RULES = [
    ("id_cmpt_movel IS NOT NULL AND NOT regexp_full_match(id_cmpt_movel, '[0-9]{6}')",
     "id_cmpt_movel fora do formato YYYYMM"),
    ("regexp_full_match(id_cmpt_movel, '[0-9]{6}') AND NOT (TRY_CAST(substr(id_cmpt_movel, 5, 2) AS INTEGER) BETWEEN 1 AND 12)",
     "id_cmpt_movel com mes invalido"),
    ("cd_operadora IS NOT NULL AND NOT regexp_full_match(cd_operadora, '[0-9]+')",
     "cd_operadora deve conter apenas digitos"),
    ("cd_municipio IS NOT NULL AND NOT regexp_full_match(cd_municipio, '[0-9]{6,7}')",
     "cd_municipio fora do formato esperado"),
    ("sg_uf IS NULL", "sg_uf ausente ou invalida"),
    ("tp_sexo IS NOT NULL AND tp_sexo NOT IN ('F', 'M', 'I')", "tp_sexo fora do dominio esperado"),
    ("nr_cnpj IS NOT NULL AND length(nr_cnpj) <> 14", "nr_cnpj deve conter 14 digitos"),
    ("qt_beneficiario_ativo IS NOT NULL AND qt_beneficiario_ativo < 0", "qt_beneficiario_ativo negativa"),
    ("qt_beneficiario_aderido IS NOT NULL AND qt_beneficiario_aderido < 0", "qt_beneficiario_aderido negativa"),
    ("qt_beneficiario_cancelado IS NOT NULL AND qt_beneficiario_cancelado < 0", "qt_beneficiario_cancelado negativa"),
    ("dt_carga IS NULL", "dt_carga ausente ou invalida"),
]


def _reason_sql() -> str:
    missing = [f"CASE WHEN {c} IS NULL THEN {lit(c + ' ausente')} END" for c in MOVEMENT_KEY]
    rules = [f"CASE WHEN {cond} THEN {lit(reason)} END" for cond, reason in _RULES]
    return f"NULLIF(concat_ws('; ', {', '.join(missing + rules)}), '')"


_DEDUPE_ORDER = "dt_carga DESC NULLS LAST, _bronze_ingested_at DESC NULLS LAST, _source_path DESC NULLS LAST, _bronze_record_hash DESC NULLS LAST"


def entity_body(spec, source: str = "valid") -> str:
    """Latest row per key of ``source`` (rows with a full key), entity columns + record hash."""
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
    return f"""SELECT {cols(spec.columns)}, {rhash(spec.hash_columns)} AS _record_hash
    FROM (SELECT *, row_number() OVER (PARTITION BY {cols(spec.keys)} ORDER BY {_DEDUPE_ORDER}) AS rn
          FROM {source} WHERE {not_null})
    WHERE rn = 1"""


def _entity_cte(name: str, spec, source: str = "valid") -> str:
    return f"{name} AS (\n    {entity_body(spec, source)}\n)"


SILVER_CTES = f"""
cleaned AS (
    SELECT {", ".join(f"{_clean_expr(c)} AS {c}" for c in BUSINESS_COLUMNS)},
           {cs('_source_path')} AS _source_path,
           {cs('_record_hash')} AS _bronze_record_hash,
           _ingested_at AS _bronze_ingested_at,
           {cu('_source_system')} AS _source_system,
           {cs('_batch_id')} AS _batch_id,
           TIMESTAMP '{AS_OF}' AS _ingested_at,
           'silver' AS _layer
    FROM bronze
),
classified AS (
    SELECT *, {_reason_sql()} AS _rejection_reason FROM cleaned
),
valid AS (SELECT * EXCLUDE (_rejection_reason) FROM classified WHERE _rejection_reason IS NULL),
rejected AS (
    SELECT {cols(REJECTED_COLUMNS[:-1])}, TIMESTAMP '{AS_OF}' AS _rejected_at,
           {rhash(REJECTED_HASH)} AS _record_hash
    FROM classified WHERE _rejection_reason IS NOT NULL
),
{_entity_cte('s_movement', MOVEMENT)},
{_entity_cte('s_insurer', INSURER)},
{_entity_cte('s_municipality', MUNICIPALITY)},
{_entity_cte('s_plan', PLAN)}"""


# ---------------------------------------------------------------- gold
def _dim_cte(name: str, spec, source: str) -> str:
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
    payload = [spec.sk] + spec.columns
    return f"""{name} AS (
    SELECT {spec.sk}, {cols(spec.columns)}, {rhash(payload)} AS _record_hash, _batch_id,
           TIMESTAMP '{AS_OF}' AS _gold_ingested_at, 'gold' AS _layer
    FROM (SELECT *, {khash(spec.keys, spec.namespace)} AS {spec.sk},
                 row_number() OVER (PARTITION BY {cols(spec.keys)}
                                    ORDER BY _batch_id DESC NULLS LAST, _record_hash DESC NULLS LAST) AS rn
          FROM {source} WHERE {not_null})
    WHERE rn = 1
)"""


_P = DIM_PROFILE
GOLD_CTES = f"""
{_dim_cte('d_insurer', DIM_INSURER, 's_insurer')},
{_dim_cte('d_municipality', DIM_MUNICIPALITY, 's_municipality')},
{_dim_cte('d_plan', DIM_PLAN, 's_plan')},
d_profile AS (
    SELECT {_P.sk}, {cols(_P.keys)}, {rhash([_P.sk] + _P.keys)} AS _record_hash, _batch_id,
           TIMESTAMP '{AS_OF}' AS _gold_ingested_at, 'gold' AS _layer
    FROM (SELECT {cols(_P.keys)}, max(_batch_id) AS _batch_id, {khash(_P.keys, _P.namespace)} AS {_P.sk}
          FROM s_movement WHERE {" AND ".join(f"{k} IS NOT NULL" for k in _P.keys)}
          GROUP BY {cols(_P.keys)})
),
periods AS (
    SELECT *,
           TRY_CAST(substr(id_cmpt_movel, 1, 4) AS INTEGER) AS ano_competencia,
           TRY_CAST(substr(id_cmpt_movel, 5, 2) AS INTEGER) AS mes_competencia,
           CAST(try_strptime(id_cmpt_movel || '01', '%Y%m%d') AS DATE) AS dt_competencia
    FROM s_movement
),
fact AS (
    SELECT {cols(FACT_PAYLOAD)}, {rhash(FACT_PAYLOAD)} AS _record_hash, _batch_id,
           TIMESTAMP '{AS_OF}' AS _gold_ingested_at, 'gold' AS _layer
    FROM (SELECT *, strftime(dt_competencia, '%Y-%m') AS ds_competencia,
                 {khash(DIM_INSURER.keys, DIM_INSURER.namespace)} AS sk_operadora,
                 {khash(DIM_MUNICIPALITY.keys, DIM_MUNICIPALITY.namespace)} AS sk_municipio,
                 {khash(DIM_PLAN.keys, DIM_PLAN.namespace)} AS sk_plano,
                 {khash(DIM_PROFILE.keys, DIM_PROFILE.namespace)} AS sk_perfil_beneficiario
          FROM periods)
),
latest AS (
    SELECT * FROM fact WHERE id_cmpt_movel = (SELECT max(id_cmpt_movel) FROM fact)
)"""

ALL_CTES = RAW_CTES + "," + SILVER_CTES + "," + GOLD_CTES


def with_ctes(select: str, ctes: str = ALL_CTES) -> str:
    """A full statement: the CTE chain (unused CTEs are dropped by DuckDB) + the query."""
    return f"WITH {ctes.strip()}\n{select.strip()}"
