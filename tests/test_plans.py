"""What the registered queries' plans shuffle, and the size of the methods that Spark generates for them."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from strata.functions.cleaning import clean_string, clean_upper
from strata.operators.dedupe import latest_per_key
from strata.plans import reports
from strata.queries import Layers, queries


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Three months of one insurer's plan, two lines of one key in each, delivered twice (order keys divisible by 53)."""
    root = tmp_path_factory.mktemp("tables")
    lines = [(53 * k, 1, 1, n, float(k), "N", "O", datetime.datetime(1996, k, 3)) for k in (1, 2, 3) for n in (1, 2)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    for name, rows, schema in (
        ("lineitem", lines, columns),
        ("orders", [(53 * k, 1, "1-URGENT") for k in (1, 2, 3)], "o_orderkey long, o_custkey long, o_orderpriority string"),
        ("customer", [(1, 2, "BUILDING")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        ("nation", [(2, "BRAZIL")], "n_nationkey int, n_name string"),
        ("supplier", [(1, "Supplier#1")], "s_suppkey long, s_name string"),
        ("part", [(1, "Brand#1", "TIN", 2)], "p_partkey long, p_brand string, p_type string, p_size int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return f"file://{root}"


@pytest.fixture
def shuffling(spark):
    """Joins as on tables too large to broadcast, and plans as they are before any run."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "10000"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan: str) -> dict[str, set[str]]:
    """The columns read of each table, over all of its scans."""
    read = {}
    for table, columns in re.findall(r"/(\w+)\.parquet\].*?ReadSchema: struct<([^>]*)>", plan):
        read.setdefault(table, set()).update(c.split(":")[0] for c in columns.split(",") if c)
    return read


@pytest.mark.parametrize("name", ["batch_audit", "latest_batch", "latest_source_period"])
def test_bronze_queries_read_only_what_they_need(spark, sf_dir, shuffling, name):
    read = scans(plan_of(queries()[name](spark, sf_dir)))
    assert read["lineitem"] == {"l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"}
    assert read["part"] == {"p_partkey"} and read["supplier"] == {"s_suppkey"}


@pytest.mark.parametrize("name", ["latest_source_period", "periods_in_range"])
def test_periods_are_read_by_link_not_by_row(spark, sf_dir, shuffling, name):
    query = queries()[name](spark, sf_dir)
    lines = plan_of(query).splitlines()
    reading = [n for n, line in enumerate(lines) if "UrlCodec" in line]
    assert len(reading) == 1 and "Generate explode" in lines[reading[0]], lines
    assert "HashAggregate(keys=[link" in lines[reading[0] + 1], lines
    assert max(r["period"] for r in query.collect()) == "199603"


def test_allowed_names_are_read_by_file_not_by_row(spark, sf_dir, shuffling):
    html = '<a href="a/one.csv">1</a><a href="Part-3.csv">2</a><a href="two.zip">3</a>'
    spark.createDataFrame([(1, html), (2, html), (3, None)], "page_id long, html string").write.mode("overwrite").parquet(f"{sf_dir}/pages.parquet")
    query = queries()["allowed_files"](spark, sf_dir)
    lines = plan_of(query).splitlines()
    reading = [n for n, line in enumerate(lines) if "regexp_extract(_source_path" in line]
    assert len(reading) == 1 and "Generate explode" in lines[reading[0]], lines
    assert "HashAggregate(keys=[_source_path" in lines[reading[0] + 1], lines
    assert sorted(r["file_name"] for r in query.collect()) == ["one.csv", "part-1.csv", "part-2.csv"]


@pytest.mark.parametrize("name", ["silver_rejected", "silver_metadata", "reject_reason_counts", "clean_string", "clean_upper", "batch_audit"])
def test_rows_are_derived_once_and_no_layer_is_staged(spark, sf_dir, shuffling, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    read = re.findall(r"Location: [^\[]*\[file:([^\],]*)/(\w+)\.parquet\]", plan)
    assert len(read) == plan.count("FileScan") and {f"file://{folder}" for folder, _ in read} == {sf_dir}, plan
    assert sorted(t for _, t in read) == ["customer", "lineitem", "nation", "orders", "part", "supplier"]


def test_the_latest_month_reaches_the_scan(spark, sf_dir, shuffling):
    layers = Layers(spark, sf_dir)
    report = reports.latest_summary(layers.fact, months=layers.months)
    plan = plan_of(report)
    filters = re.findall(r"Filter [^\n]*scalar-subquery", plan) or re.findall(r"Filter [^\n]*Subquery", plan)
    assert any("l_orderkey" in f and "_rejection_reason" not in f for f in filters), plan
    row = report.first()
    assert (row["id_cmpt_movel"], row["linhas_fato"], row["beneficiarios_ativos"]) == ("199603", 1, 3)
    assert layers.months.select(F.max("id_cmpt_movel")).first() == layers.s_movement.select(F.max("id_cmpt_movel")).first()


def test_replaced_partitions_are_those_of_the_two_latest_months(spark, sf_dir):
    rows = queries()["partition_replace"](spark, sf_dir).select("id_cmpt_movel", "qt_beneficiario_ativo").collect()
    assert sorted(map(tuple, rows)) == [("199601", 1), ("199602", 3), ("199603", 4)]


def test_latest_rows_are_shuffled_once_and_without_unread_columns(spark, shuffling):
    df = spark.createDataFrame([("k", 1, "a", "b")], "k string, o int, v string, unread string")
    plan = plan_of(latest_per_key(df, ["k"], ["o"]).select("k", "v"))
    assert plan.count("Exchange") == 1 and "unread" not in plan.split("Exchange")[0]
    assert re.search(r"Project \[[^\]]*\]", plan.split("Exchange")[1]) and "max_by" not in plan


def test_digests_travel_as_bytes(spark, shuffling):
    one, two = "0a" * 32, "ff" * 32
    rows = [("k", 1, two), ("k", 1, one), ("k", 0, "z"), ("l", 1, "z"), ("l", 1, "é"), ("m", 1, None), ("m", 1, one), ("n", 1, None), ("o", 1, "0A" * 32), ("p", 1, "0a1")]
    df = spark.createDataFrame(rows, "k string, o int, h string")
    latest = latest_per_key(df, ["k"], ["o", "h"], digest="h")
    found = {tuple(r) for r in latest.collect()}
    assert found == {("k", 1, two), ("l", 1, "é"), ("m", 1, one), ("n", 1, None), ("o", 1, "0A" * 32), ("p", 1, "0a1")}
    assert found == {tuple(r) for r in latest_per_key(df, ["k"], ["o", "h"]).collect()}
    below = plan_of(latest).split("Exchange")[1]
    sent = re.search(r"Project \[(.*)\]", below)[1]
    assert "unhex" in sent and re.match(r"k#\d+, o#\d+, CASE", sent), sent  # not the digest itself


def test_replaced_partitions_are_broadcast(spark, sf_dir, shuffling):
    assert re.search(r"BroadcastHashJoin [^\n]*LeftAnti", plan_of(queries()["partition_replace"](spark, sf_dir)))


@pytest.mark.parametrize("name", ["profile_sex_age", "by_relationship"])
def test_profiles_of_a_report_need_no_latest_rows(spark, sf_dir, shuffling, name):
    assert plan_of(queries()[name](spark, sf_dir)).count("Window [row_number()") == 1  # the fact's
    layers = Layers(spark, sf_dir)
    columns = ["sk_perfil_beneficiario", "tp_sexo", "de_faixa_etaria", "tipo_vinculo"]
    assert sorted(layers.profiles.select(columns).collect()) == sorted(layers.d_profile.select(columns).collect())


@pytest.mark.parametrize("name", ["silver_movement", "silver_rejected", "dim_plan"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, sf_dir, shuffling, name):
    execution = queries()[name](spark, sf_dir)._jdf.queryExecution()
    code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(execution, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000  # HotSpot leaves larger ones to the interpreter


def test_rules_are_evaluated_once(spark, sf_dir, shuffling):
    plan = plan_of(Layers(spark, sf_dir).valid)
    assert re.search(r"Filter isnull\(_rejection_reason", plan)  # as a column: neither rules nor cleaning are copied into the filter


def test_null_tokens_of_own_and_of_any_spelling(spark):
    df = spark.createDataFrame([(" n/a ",), ("-",), (" x ",), (None,), ("",), ("nan",), ("\ta",), ("zero",)], "c string")
    assert [r[0] for r in df.select(clean_string("c")).collect()] == [None, None, "x", None, None, None, "\ta", "zero"]
    assert [r[0] for r in df.select(clean_upper("c")).collect()] == [None, None, "X", None, None, None, "\tA", "ZERO"]
    assert [r[0] for r in df.select(clean_string("c", ["ZERO"])).collect()] == ["n/a", "-", "x", None, "", "nan", "\ta", None]
    assert [r[0] for r in df.select(clean_string("c", [])).collect()] == ["n/a", "-", "x", None, "", "nan", "\ta", "zero"]
