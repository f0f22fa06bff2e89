"""Rows that travel narrower come out as they were, and merges and replaces read no more than they need."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from strata.functions.packing import pack, unpack
from strata.operators.dedupe import latest_per_key, latest_values
from strata.operators.merge import merge_frames
from strata.plans import silver
from strata.queries import Layers, queries
from strata.sources.csv import read_csv, write_csv
from strata.sources.fixture import raw_loads, raw_movement
from tests.test_plans import plan_of, shuffling  # noqa: F401

ODD = ["", None, "a", "a\u0001b", "\u0001", "\u0002", "\u00021", "\u0002\u0001", "\u00022", "\u00020", " é ", "\\u0001"]


def day(month, year=1996):
    return datetime.datetime(year, month, 3)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Lines of three years with values that do not fit a small number, are null, or are no known flag."""
    root = tmp_path_factory.mktemp("tables")
    lines = [
        (53, 1, 1, 1, 5.0, "N", "O", day(1)),
        (53, 1, 1, 2, 6.0, "A", "F", day(1)),
        (54, 2, 1, -3, 7.0, "R", "O", day(2)),
        (54, 2, 1, 1 << 20, 8.0, "R", "F", day(3)),
        (55, 1, 2, 4, -9.0, "A", None, day(4)),
        (55, 1, 2, 5, float(1 << 28), None, "O", day(5, 1997)),
        (55, 2, 2, None, 1.0, "X", "X", day(6, 1997)),
        (55, 2, 2, 6, None, "", "", day(7, 1997)),
        (56, 1, 1, 7, 3.0, "N", "O", day(7, 1997)),
        (56, 1, 1, 8, 3.0, "N", "O", None),
        (57, 1, 1, 1, 2.0, "N", "O", day(12, 1999)),  # an order that there is not
        (505, 1, 1, 1, 2.0, "N", "O", day(11, 1998)),  # month 13
    ]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    orders = [(53, 1, "1-URGENT"), (54, 2, None), (55, 1, "\u0001"), (56, 2, "5-LOW"), (505, 1, "5-LOW")]
    for name, rows, schema in (
        ("lineitem", lines, columns),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderpriority string"),
        ("customer", [(1, 2, "BUILDING"), (2, 2, "")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        ("nation", [(2, "BRAZIL")], "n_nationkey int, n_name string"),
        ("supplier", [(1, "Supplier#1"), (2, None)], "s_suppkey long, s_name string"),
        ("part", [(1, "Brand#1", "TIN", 2), (2, None, "", None)], "p_partkey long, p_brand string, p_type string, p_size int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return f"file://{root}"


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_texts_come_back_as_they_were(spark):
    df = spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in ODD for b in ODD for c in ("x", None))], "i int, a string, b string, c string")
    packed = df.select("i", pack(["a", "b", "c"]).alias("p"))
    assert rows(unpack(packed, "p", ["a", "b", "c"])) == rows(df)
    assert packed.select("p").distinct().count() == df.count()  # equal just if all is equal
    alone = df.select("i", "b", pack(["a"]).alias("p"))
    assert rows(unpack(alone, "p", ["a"]).select("i", "a", "b")) == rows(df.select("i", "a", "b"))


def test_whole_rows_are_the_same_rows(spark, sf_dir, shuffling):  # noqa: F811
    apart, whole = (raw_movement(spark, sf_dir, whole=w) for w in (False, True))
    assert apart.schema == whole.schema and rows(apart) == rows(whole)
    assert len(rows(whole)) == 13  # two lines come twice, one has no order
    sent = re.findall(r"Exchange[^\n]*hashpartitioning\(l_suppkey[^\n]*\n[^\n]*Project \[([^\n]*)\]", plan_of(Layers(spark, sf_dir).s_movement))
    assert sent and all(re.search(r" AS other#\d+$", p) and not re.search(r"(^|, )(flag|is_open)#", p) for p in sent), sent


def test_packed_latest_rows_are_the_same_rows(spark):
    data = [(a, b, i % 3, "h", c) for i, (a, b, c) in enumerate((a, b, c) for a in ODD for b in ODD for c in ODD[:3])]
    df = spark.createDataFrame(data, "a string, b string, o int, h string, v string")
    plain = latest_per_key(df, ["a", "b"], ["o", "h"])
    for packed in (["a", "b"], ["b"], ["a", "v"], ["a", "b", "v"]):
        narrow = latest_per_key(df, ["a", "b"], ["o", "h"], packed=packed)
        assert narrow.columns == df.columns and rows(narrow) == rows(plain), packed
    for unfit in ("h", "o"):
        with pytest.raises(ValueError, match="cannot be packed"):
            latest_per_key(df, ["a", "b"], ["o", "h"], packed=[unfit])


@pytest.mark.parametrize("name", ["silver_movement", "all_string_cast", "fact_movement", "dedupe_latest", "partition_replace"])
def test_keys_of_latest_rows_travel_as_one_text(spark, sf_dir, shuffling, name):  # noqa: F811
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "row_number" in plan
    for by in re.findall(r"Exchange hashpartitioning\(([^\n]*)ENSURE_REQUIREMENTS", plan):
        assert not re.search(r"\b(cd_plano|de_faixa_etaria)#", by), by


def test_the_latest_digests_of_a_dedupe_travel_as_bytes(spark, sf_dir, shuffling):  # noqa: F811
    sent = [p for p in plan_of(queries()["dedupe_latest"](spark, sf_dir)).split("Exchange") if "__bytes" in p]
    assert sent and "unhex(_bronze_record_hash" in sent[-1]


def test_latest_values_look_at_the_greatest_first(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("d",), ("d",)], "m string")
    among = spark.createDataFrame([(c,) for c in "abcdefgz"] + [(None,)], "m string")
    for n, found in ((1, ["d"]), (2, ["d", "b"]), (3, ["d", "b", "a"]), (9, ["d", "b", "a"])):
        assert latest_values(df, "m", n, among) == found
    assert latest_values(df.where("m is null"), "m", 2, among) == [] == latest_values(df, "m", 1, among.where("m is null"))


def test_latest_months_and_batches_are_those_of_valid_rows(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    for column in ("id_cmpt_movel", "_batch_id"):
        known = sorted({r[0] for r in layers.valid.select(column).collect()}, reverse=True)
        assert len(known) > 1 and layers.latest(column, 2) == known[:2]
    loads = {tuple(r) for r in raw_loads(spark, sf_dir).collect()}
    assert {tuple(r) for r in raw_movement(spark, sf_dir).select("id_cmpt_movel", "_batch_id").collect()} < loads


@pytest.mark.parametrize("name", ["scd1_merge", "scd1_merge_insert_only"])
def test_a_merge_leaves_the_latest_rows_where_they_are(spark, sf_dir, shuffling, name):  # noqa: F811
    merged = queries()[name](spark, sf_dir)
    plan = plan_of(merged)
    assert not re.search(r"hashpartitioning\((coalesce|isnull)\([^\n]*\n[^\n]*\n?[^\n]*Window \[row_number", plan)
    # lines, orders and customers, parts of target and source, their latest rows, and the source's once more
    by_plan = [e for e in re.findall(r"Exchange hashpartitioning\(([^\n]*)ENSURE", plan) if "cd_plano" in e]
    assert len(by_plan) == 3, by_plan
    valid = Layers(spark, sf_dir).valid
    keys = {(r["cd_operadora"], r["cd_plano"]) for r in valid.collect()}
    assert {(r["cd_operadora"], r["cd_plano"]) for r in merged.collect()} == keys and merged.count() == len(keys)


def test_keys_that_one_side_holds_non_null_match_alike(spark):
    schema = "k string, v string, _record_hash string"
    target = spark.createDataFrame([("a", "1", "x"), ("", "2", "y")], schema)
    source = spark.createDataFrame([("a", "3", "z"), (None, "4", "w"), ("", "5", "y")], schema)
    held = target.withColumn("k", F.coalesce("k", F.lit("")))
    assert not held.schema["k"].nullable
    assert rows(merge_frames(held, source, ["k"])) == rows(merge_frames(target, source, ["k"]))
    assert len(rows(merge_frames(held, source, ["k"]))) == 3


def test_entities_hold_their_keys_non_null(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    for spec, entity in ((silver.PLAN, layers.s_plan), (silver.INSURER, layers.s_insurer)):
        assert [entity.schema[k].nullable for k in spec.keys] == [False] * len(spec.keys)


def test_compressed_files_hold_what_plain_ones_do(spark, tmp_path):
    data = [(i, a, b, f"p{i % 2}") for i, (a, b) in enumerate((a, b) for a in ["", None, " a ", 'q"x', "a;b", "é", "\u0002"] for b in ["1", None])]
    df = spark.createDataFrame(data, "n int, a string, `B ç` string, part string")
    write_csv(df, f"file://{tmp_path}/plain", ["part"])
    write_csv(df, f"file://{tmp_path}/small", ["part"], compression="gzip")
    plain = read_csv(spark, f"file://{tmp_path}/plain").drop("_source_path")
    small = read_csv(spark, f"file://{tmp_path}/small", glob="*.csv.gz").drop("_source_path")
    assert plain.columns == small.columns == ["n", "a", "b_c"] and rows(plain) == rows(small) and plain.count() == len(data)
    assert rows(plain) == sorted(repr((str(n), a or None, b)) for n, a, b, _ in data)  # an empty cell is null
    files = [p.name for p in (tmp_path / "small").rglob("part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert {p.name for p in (tmp_path / "small").iterdir() if p.is_dir()} == {"part=p0", "part=p1"}
