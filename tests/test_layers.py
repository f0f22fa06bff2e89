import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import require_columns
from strata.plans import layers, reports, silver, tables
from strata.queries import Layers
from strata.session import checkpoint_root
from tests.conftest import SF_SMALL

HEADER = [c.upper() for c in silver.RAW_COLUMNS]
VALUES = dict(zip(HEADER, "202401;10;ACME;12345678000100;X;SP;355030;SAO PAULO;F;A;B;7;A;C;S;N;M;TITULAR;5;1;0;2024-01-05".split(";")))


def names():
    suffix = uuid.uuid4().hex[:6]
    return layers.Names(**{k: "{}_{}.{}".format(v.split(".")[0], suffix, v.split(".")[1]) for k, v in vars(layers.Names()).items()})


def write(folder, name, header=HEADER, **changed):
    folder.mkdir(parents=True, exist_ok=True)
    row = VALUES | changed
    (folder / name).write_text(";".join(header) + "\n" + ";".join(row.get(h, "?") for h in header) + "\n")


def test_odd_file_names_are_loaded_once_and_reordered_rows_hash_alike(spark, tmp_path):
    own = names()
    write(tmp_path / "raw", "a b.csv")
    write(tmp_path / "raw", "a[1].csv", HEADER[::-1])
    first = layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    assert (first["files"], first["rows"]) == (2, 2)
    assert spark.table(own.bronze).select("_record_hash").distinct().count() == 1
    assert layers.load_bronze(spark, f"file://{tmp_path}/raw", own)["files"] == 0
    write(tmp_path / "raw", "c.csv")
    assert layers.load_bronze(spark, f"file://{tmp_path}/raw", own)["rows"] == 1
    assert spark.table(own.bronze).count() == 3


def test_passes_of_few_files_load_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "FILES_AT_ONCE", 2)
    own = names()
    for i in range(5):
        write(tmp_path / "raw", f"{i}.csv", CD_OPERADORA=str(i))
    assert layers.load_bronze(spark, f"file://{tmp_path}/raw", own)["rows"] == 5
    assert spark.table(own.bronze).select("cd_operadora").distinct().count() == 5


def test_other_columns_are_refused_or_dropped(spark, tmp_path):
    own = names()
    write(tmp_path / "more", "a.csv", [*HEADER, "NEW"])
    with pytest.raises(ValueError, match="outside the contract.*new"):
        layers.load_bronze(spark, f"file://{tmp_path}/more", own)
    assert layers.load_bronze(spark, f"file://{tmp_path}/more", own, extra_columns="drop")["rows"] == 1
    write(tmp_path / "less", "a.csv", HEADER[:-1])
    with pytest.raises(ValueError, match="lack.*dt_carga"):
        layers.load_bronze(spark, f"file://{tmp_path}/less", names())


def test_a_load_that_fails_before_its_ledger_is_cleared(spark, tmp_path, monkeypatch):
    own = names()
    write(tmp_path / "raw", "a.csv")
    layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    write(tmp_path / "raw", "b.csv")
    real = tables.append

    def failing(df, name, *args):
        if name == own.files:
            raise RuntimeError("lost")
        return real(df, name, *args)

    with monkeypatch.context() as patched:
        patched.setattr(tables, "append", failing)
        with pytest.raises(RuntimeError):
            layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    assert spark.table(own.bronze).count() == 2  # the second batch is there, unfinished
    assert layers.load_bronze(spark, f"file://{tmp_path}/raw", own)["rows"] == 1
    assert spark.table(own.bronze).count() == 2
    assert spark.table(own.bronze).select("_source_path").distinct().count() == 2


def test_incremental_merge_equals_snapshot_replace_and_gold_reads_the_batch_only(spark, tmp_path):
    own, other = names(), names()
    for n, full in ((own, True), (other, False)):
        for month in ("202401", "202402"):
            write(tmp_path / month, "a.csv", ID_CMPT_MOVEL=month)
            layers.load_bronze(spark, f"file://{tmp_path}/{month}", n)
            layers.load_silver(spark, n, full_snapshot=full)
            layers.load_gold(spark, n, full_snapshot=full)
    keep = [c for c in spark.table(own.fact).columns if c.startswith(("sk_", "id_", "qt_"))]
    facts = [sorted(tuple(r) for r in spark.table(n.fact).select(keep).collect()) for n in (own, other)]
    assert facts[0] == facts[1] and len(facts[0]) == 2
    for dim, sk in ((own.dim_plan, "sk_plano"), (own.dim_profile, "sk_perfil_beneficiario")):
        assert spark.table(own.fact).join(spark.table(dim), sk, "left_anti").count() == 0
    assert spark.table(own.months).count() == 2


@pytest.mark.parametrize("spec", [silver.INSURER, silver.MUNICIPALITY, silver.PLAN, silver.MOVEMENT])
def test_gold_names_each_missing_column(spark, spec):
    columns = [*spec.columns, "_record_hash"]
    for gone in columns:
        frame = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns if c != gone))
        with pytest.raises(ValueError, match=gone):
            require_columns(frame, columns)


def test_latest_month_reports_prune_partitions(spark):
    checkpoint_root(spark)
    tables_of = Layers(spark, SF_SMALL)
    report = reports.latest_summary(tables_of.fact_table)
    plan = report._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert any("id_cmpt_movel" in f.split("PartitionFilters:")[1] and "subquery" in f for f in filters)
    months = tables_of.fact_table.select(F.max("id_cmpt_movel")).first()[0]
    assert report.first()["id_cmpt_movel"] == months


def test_the_plan_dimension_joins_the_fact_without_a_shuffle(spark, tmp_path):
    own = names()
    for k, (month, plan) in enumerate([("202401", "7"), ("202401", "8"), ("202402", "8"), ("202402", "9")]):
        write(tmp_path / "raw", f"{k}.csv", ID_CMPT_MOVEL=month, CD_PLANO=plan, DE_SEGMENTACAO_PLANO=f"S{plan}")
    for _ in range(2):  # created, then replaced and merged
        layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
        layers.load_silver(spark, own)
        layers.load_gold(spark, own)
        write(tmp_path / "raw", "again.csv", ID_CMPT_MOVEL="202402", CD_PLANO="9", DE_SEGMENTACAO_PLANO="NEW", DT_CARGA="2024-03-01")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fact, plans = spark.table(own.fact), tables.rows_of(spark, own.dim_plan)
        joined = fact.join(plans, "sk_plano").select("id_cmpt_movel", "cd_plano", "de_segmentacao_plano")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        report = reports.plan_distribution(fact, plans)
        shuffles = report._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1]
        assert "Exchange hashpartitioning(sk_plano" not in shuffles
        assert {(r.de_segmentacao_plano, r.beneficiarios_ativos) for r in report.collect()} == {("NEW", 5)}  # its month was replaced
        assert sorted((r[0], r[1]) for r in joined.collect()) == [("202401", "7"), ("202401", "8"), ("202402", "9")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
