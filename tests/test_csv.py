import os

import pytest

from strata.plans.bronze import bronze_from_files
from strata.sources.csv import list_files, read_csv


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_strings_spaces_quotes_and_nested_folders(spark, tmp_path):
    write(f"{tmp_path}/202401/a.csv", 'A;B\r\n 1 ;"x;y"\r\n\r\n;""\r\n')
    write(f"{tmp_path}/202402/nested/b.csv", "A;B\n2;NULL\n3\n4;5;6\n")
    got = rows(read_csv(spark, f"file://{tmp_path}"), "a", "b")
    assert got == sorted([(" 1 ", "x;y"), (None, None), ("2", "NULL"), ("3", None), ("4", "5")], key=str)


def test_reordered_headers_are_read_by_name_and_hash_alike(spark, tmp_path):
    write(f"{tmp_path}/a.csv", "CD_OPERADORA;SG_UF;X\n10;SP;1\n")
    write(f"{tmp_path}/b.csv", "﻿X;SG_UF;CD_OPERADORA;NM_MUNICÍPIO\n1;SP;10;Rio\n")
    raw = read_csv(spark, f"file://{tmp_path}")
    assert rows(raw, "cd_operadora", "sg_uf", "x", "nm_municipio") == [("10", "SP", "1", "Rio"), ("10", "SP", "1", None)]
    contract = ["cd_operadora", "sg_uf", "x"]
    hashed = bronze_from_files(raw, "b", contract, extra_columns="drop")
    assert hashed.select("_record_hash").distinct().count() == 1
    with pytest.raises(ValueError, match="outside the contract.*nm_municipio"):
        bronze_from_files(raw, "b", contract)
    with pytest.raises(ValueError, match="lack.*zz"):
        bronze_from_files(raw, "b", [*contract, "zz"], extra_columns="drop")


def test_a_header_longer_than_a_block_of_any_size(spark, tmp_path):
    names = [f"column_{i:06d}_{'x' * 40}" for i in range(2000)]  # 110 KB
    values = [str(i) for i in range(2000)]
    swapped = [*names[:-2], names[-1], names[-2]]
    write(f"{tmp_path}/a.csv", ";".join(names) + "\n" + ";".join(values) + "\n")
    write(f"{tmp_path}/b.csv", ";".join(swapped) + "\n" + ";".join([*values[:-2], values[-1], values[-2]]) + "\n")
    assert rows(read_csv(spark, f"file://{tmp_path}"), names[0], names[-2], names[-1]) == [("0", "1998", "1999")] * 2


def test_names_with_blanks_and_pattern_characters(spark, tmp_path):
    for i, name in enumerate(["a b.csv", "c[1].csv", "c1.csv", "d{2}.csv", "e%20f.csv"]):
        write(f"{tmp_path}/in/{name}", f"K\n{i}\n")
    files = {r["_source_path"]: r["path"] for r in list_files(spark, f"file://{tmp_path}/in").collect()}
    assert len(files) == 5
    for source_path, path in files.items():
        got = read_csv(spark, [path]).collect()
        assert [r["_source_path"] for r in got] == [source_path]  # one spelling, and just this file


def test_refusals(spark, tmp_path):
    with pytest.raises(Exception):
        read_csv(spark, f"file://{tmp_path}/none")
    write(f"{tmp_path}/a.csv", 'A;"B\n1;2\n')
    with pytest.raises(ValueError, match="spans lines"):
        read_csv(spark, f"file://{tmp_path}")
    write(f"{tmp_path}/b/a.csv", "A b;a-B\n1;2\n")
    with pytest.raises(ValueError, match="collide"):
        read_csv(spark, f"file://{tmp_path}/b")
