import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import (
    add_hash_key,
    add_record_hash,
    cast_all_to_string,
    clean_string,
    clean_upper,
    hash_key,
    in_domain,
    normalize_column_name,
    normalize_columns,
    only_digits,
    parse_date,
    parse_long,
    record_hash,
)


def one_col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


def test_clean_string_truth_table(spark):
    values = [None, "", "  ", " x ", "null", "N/a", "na", "NaN", "-", "none", "NONE ", "\tx", "a b"]
    assert one_col(spark, values, clean_string) == [
        None, None, None, "x", None, None, None, None, None, None, None, "\tx", "a b"
    ]


def test_clean_upper(spark):
    assert one_col(spark, [" abc ", "n/a", None], clean_upper) == ["ABC", None, None]


def test_only_digits(spark):
    assert one_col(spark, ["12.345/0001-99", "abc", " 2024-01 ", "NA", None], only_digits) == [
        "12345000199", None, "202401", None, None
    ]


def test_parse_long(spark):
    values = ["R$ 1.234", "1,5", "5-", "-17", " 42 ", "abc", "99999999999999999999", "--1", None]
    assert one_col(spark, values, parse_long) == [1234, 15, None, -17, 42, None, None, None, None]


def test_parse_date_layouts_in_order(spark):
    values = ["2024-01-05", "06/02/2024", "20240307", "2024-1-5", "sem data", "2024-02-30", None]
    assert one_col(spark, values, parse_date) == [
        dt.date(2024, 1, 5), dt.date(2024, 2, 6), dt.date(2024, 3, 7), None, None, None, None
    ]


def test_in_domain(spark):
    assert one_col(spark, ["SP", "XX", None], lambda c: in_domain(F.col(c), ["SP", "RJ"])) == ["SP", None, None]


def test_record_hash_null_is_empty_string(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    hashes = [r[0] for r in df.select(record_hash(["x", "y"])).collect()]
    assert hashes[0] == hashes[1]
    import hashlib

    assert hashes[0] == hashlib.sha256("a||".encode()).hexdigest()


def test_hash_key_namespace_trim_and_null_token(spark):
    import hashlib

    df = spark.createDataFrame([(" 12 ", None)], "a string, b string")
    got = df.select(hash_key(["a", "b"], "dim_x")).first()[0]
    assert got == hashlib.sha256("dim_x||12||__NULL__".encode()).hexdigest()
    other = df.select(hash_key(["a", "b"], "dim_y")).first()[0]
    assert got != other


def test_hash_helpers_raise_on_missing_columns(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError, match="missing"):
        add_record_hash(df, ["x", "nope"])
    with pytest.raises(ValueError, match="missing"):
        add_hash_key(df, ["nope"], "sk")


def test_normalize_column_name():
    assert normalize_column_name("Nº  Razão-Social ") == "no_razao_social"
    assert normalize_column_name("__ID CMPT__MOVEL__") == "id_cmpt_movel"
    assert normalize_column_name("DE FAIXA ETÁRIA") == "de_faixa_etaria"


def test_normalize_columns_rejects_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int")
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(df)


def test_cast_all_to_string(spark):
    df = spark.createDataFrame([(1, 2.5, dt.date(2024, 1, 2))], "a int, b double, c date")
    out = cast_all_to_string(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string"] * 3
    assert tuple(out.first()) == ("1", "2.5", "2024-01-02")
