"""Raw beneficiary-movement rows derived from the driver's TPC-H-like tables.

The medallion layers need raw, all-string, partly dirty monthly rows.  This
module derives them from ``lineitem`` joined to its order, customer, nation,
supplier and part, so the work grows with the tables.  Dirt is injected by
deterministic rules on ``l_orderkey`` so that every rejection rule, cleaning
path and the deduplication have rows to act on.

Plan notes (at scale):
* ``orders ⋈ customer`` is built first; it is a quarter of ``lineitem`` and
  is then joined once on ``l_orderkey``.
* The sides that add least are joined first (``supplier``: a name), the widest
  last (``part``, then ``nation``, which needs no shuffle), so that rows are
  narrow in the shuffles.  Month and quantity are cut down before them.
* For queries that read whole rows, a line's own small values travel in one
  number and a buyer's texts in one (``whole=True``); others keep them apart, so
  that columns which they do not read stay out of the scan.
* ``nation`` has 25 rows by the TPC-H definition at every scale factor, so it
  is the only side broadcast by hint.  Every other join is left to
  Catalyst/AQE, which broadcasts at runtime only below the size threshold.
* Re-delivered ("reload") rows are produced with one ``explode`` over the
  joined rows, so the six-table join runs once, not twice.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.constants import VALID_UFS
from strata.functions.packing import pack, unpack

# Column order of a raw movement file (all strings).
BUSINESS_COLUMNS = [
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
]

# Load context of each simulated delivery: file path, load batch, load time.
LOAD_COLUMNS = ["_source_path", "_batch_id", "_ingested_at"]

# Nation n gets the n-th code.
STATES = VALID_UFS[:25]

# The return flags that rows depend on; others are alike.
FLAGS = ["A", "N", "R"]


def _flag(value: str) -> int:
    return FLAGS.index(value) + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(k: Column, n: int) -> Column:
    return (k % n) == 0


# Values below these travel in one number; a line with others has them beside it.
SMALL = {"l_linenumber": 1 << 16, "quantity": 1 << 24}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"),
        F.coalesce(F.array_position(F.array(*map(F.lit, FLAGS)), F.col("l_returnflag")), F.lit(0)).alias("flag"),
        F.coalesce(F.col("l_linestatus") == "O", F.lit(False)).alias("is_open"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym"),
    )


def _narrowed(lines: DataFrame) -> DataFrame:
    """The small values of a line in one number, ``small``, or, as far as they do not fit or are null, in ``other``.

    The month stays apart: filters on it come down to the scan, and would take this with them.
    """
    fits = reduce(and_, [F.col(c).isNotNull() & (F.col(c) >= 0) & (F.col(c) < n) for c, n in SMALL.items()])
    codes = F.col("flag") * 2 + F.col("is_open").cast("long")
    small, at = codes, 8
    for c, n in SMALL.items():
        small, at = small + F.col(c) * F.lit(at).cast("long"), at * n
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "ym", F.when(fits, small).otherwise(codes).alias("small"),
        F.when(~fits, F.struct(*SMALL)).alias("other"),
    )


def _restored(rows: DataFrame) -> DataFrame:
    """What ``_narrowed`` put together."""
    at, values = 8, {"flag": F.shiftright("small", 1).bitwiseAND(F.lit(3)), "is_open": F.col("small").bitwiseAND(F.lit(1)) == 1}
    for c, n in SMALL.items():
        own = F.shiftright("small", at.bit_length() - 1).bitwiseAND(F.lit(n - 1)).cast("int")
        values[c] = F.when(F.col("other").isNull(), own).otherwise(F.col(f"other.{c}"))
        at *= n
    return rows.withColumns(values).drop("small", "other")


def _month(k: Column, ym: Column) -> Column:
    """A line's month as its file spells it."""
    yyyy = F.substring(ym, 1, 4)
    return (
        F.when(_every(k, 101), F.concat(yyyy, F.lit("-13")))
        .when(_every(k, 103), yyyy)
        .when(_every(k, 107), F.lit(" n/a "))
        .otherwise(F.concat(yyyy, F.lit("-"), F.substring(ym, 5, 2)))
    )


def _batch(ym: Column) -> Column:
    return F.concat(F.lit("b"), F.substring(ym, 1, 4))


def raw_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months and batches of ``raw_movement``, and those of lines that its joins leave out."""
    ym = F.col("ym").cast("string")
    lines = _lines(spark, sf_dir).select(_month(F.col("l_orderkey"), ym).alias("id_cmpt_movel"), _batch(ym).alias("_batch_id"))
    return lines.distinct()


def raw_movement(spark: SparkSession, sf_dir: str, with_reload: bool = True, whole: bool = False) -> DataFrame:
    """All-string raw rows plus load context, one per lineitem (+ reloads).

    ``whole`` is for readers of all columns: it gives the same rows, narrower in the shuffles, but reads every column.
    """
    li = _lines(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")

    buyers = orders.join(customer, orders.o_custkey == customer.c_custkey)
    texts = ["c_mktsegment", "o_orderpriority"]
    if whole:
        li = _narrowed(li)
        buyers = buyers.select("o_orderkey", "c_nationkey", pack(texts).alias("texts"))
    rows = (
        li.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        # dealt by the key of the largest join, which needs this exchange anyway
        .repartition("l_orderkey")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    if whole:
        rows = unpack(_restored(rows), "texts", texts)
    reload_copies = (
        F.when(_every(F.col("l_orderkey"), 53), F.array(F.lit(False), F.lit(True))).otherwise(
            F.array(F.lit(False))
        )
        if with_reload
        else F.array(F.lit(False))
    )
    rows = rows.withColumn("_reload", F.explode(reload_copies))

    k = F.col("l_orderkey")
    sk = F.col("l_suppkey")
    is_reload = F.col("_reload")
    ym = F.col("ym").cast("string")
    yyyy = F.substring(ym, 1, 4)
    mm = F.substring(ym, 5, 2)
    qty = F.col("quantity").cast("string")
    line = F.col("l_linenumber").cast("string")
    load_year = (yyyy.cast("int") + 1).cast("string")

    return rows.select(
        _month(k, ym).alias("id_cmpt_movel"),
        F.when(_every(k, 109), F.concat(F.lit("OP"), sk.cast("string")))
        .otherwise(F.concat(F.lit(" "), sk.cast("string"), F.lit(" ")))
        .alias("cd_operadora"),
        F.concat(F.lit(" "), F.lower("s_name"), F.lit("  ")).alias("nm_razao_social"),
        F.when(_every(k, 97), F.lit("123"))
        .otherwise(F.concat(F.lpad(sk.cast("string"), 8, "0"), F.lit("/0001-00")))
        .alias("nr_cnpj"),
        F.when(sk % 3 == 0, F.lit("cooperativa"))
        .when(sk % 3 == 1, F.lit("seguradora"))
        .otherwise(F.lit("NULL"))
        .alias("modalidade_operadora"),
        F.when(_every(k, 89), F.lit("zz"))
        .otherwise(F.lower(F.get(F.array(*map(F.lit, STATES)), F.col("n_nationkey"))))
        .alias("sg_uf"),
        F.when(_every(k, 83), F.lit("12"))
        .otherwise((F.col("n_nationkey") + 100000).cast("string"))
        .alias("cd_municipio"),
        F.lower("n_name").alias("nm_municipio"),
        F.when(_every(k, 79), F.lit("x"))
        .when(F.col("flag") == _flag("A"), F.lit("f"))
        .when(F.col("flag") == _flag("N"), F.lit("M"))
        .otherwise(F.lit(" i"))
        .alias("tp_sexo"),
        F.col("c_mktsegment").alias("de_faixa_etaria"),
        F.col("o_orderpriority").alias("de_faixa_etaria_reaj"),
        F.col("l_partkey").cast("string").alias("cd_plano"),
        F.when(F.col("p_size") % 2 == 0, F.lit("a")).otherwise(F.lit("p")).alias("tp_vigencia_plano"),
        F.col("p_brand").alias("de_contratacao_plano"),
        F.col("p_type").alias("de_segmentacao_plano"),
        F.when(sk % 2 == 0, F.lit("nacional")).otherwise(F.lit("estadual")).alias("de_abrg_geografica_plano"),
        F.when(F.col("p_size") % 5 == 0, F.lit("-")).otherwise(F.lit("medico")).alias("cobertura_assist_plan"),
        F.when(_every(k, 73), F.lit("None"))
        .when(F.col("is_open"), F.lit("titular"))
        .otherwise(F.lit("dependente"))
        .alias("tipo_vinculo"),
        F.when(_every(k, 71), F.concat(F.lit("-"), qty))
        .when(_every(k, 7), F.lit("abc"))
        .otherwise(F.concat(qty, F.lit(" ")))
        .alias("qt_beneficiario_ativo"),
        F.when(is_reload, (F.col("l_linenumber") + 1).cast("string"))
        .otherwise(line)
        .alias("qt_beneficiario_aderido"),
        F.when(F.col("flag") == _flag("R"), line).otherwise(F.lit("0")).alias("qt_beneficiario_cancelado"),
        F.when(is_reload, F.concat(yyyy, F.lit("-"), mm, F.lit("-20")))
        .when(_every(k, 67), F.lit("sem data"))
        .when(k % 3 == 0, F.concat(yyyy, F.lit("-"), mm, F.lit("-05")))
        .when(k % 3 == 1, F.concat(F.lit("06/"), mm, F.lit("/"), yyyy))
        .otherwise(F.concat(yyyy, mm, F.lit("07")))
        .alias("dt_carga"),
        F.concat(
            F.when(is_reload, F.lit("raw/reload/")).otherwise(F.lit("raw/")),
            ym, F.lit("/part-"), (k % 4).cast("string"), F.lit(".csv"),
        ).alias("_source_path"),
        _batch(ym).alias("_batch_id"),
        F.to_timestamp(
            F.concat(load_year, F.when(is_reload, F.lit("-02-15 00:00:00")).otherwise(F.lit("-01-15 00:00:00")))
        ).alias("_ingested_at"),
    )
