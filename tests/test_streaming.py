import os
import tempfile
import uuid

import pytest

from strata.streaming.bronze_stream import start_bronze_stream

HEADER = ["ID_CMPT_MOVEL", "CD_OPERADORA", "QT_BENEFICIARIO_ATIVO"]


def write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(";".join(HEADER) + "\n")
        for r in rows:
            f.write(";".join(r) + "\n")


def test_stream_loads_each_file_once(spark):
    root = tempfile.mkdtemp(prefix="stream-raw-")
    table = f"s_{uuid.uuid4().hex[:6]}.bronze"
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    write(os.path.join(root, "202401"), "a.csv", [("202401", " 1 ", "5"), ("202401", "2", "7")])
    q = start_bronze_stream(spark, root, HEADER, table, checkpoint=ckpt)
    q.awaitTermination(120)
    bronze = spark.table(table)
    assert bronze.count() == 2
    assert set(bronze.columns) >= {"id_cmpt_movel", "cd_operadora", "_source_path", "_batch_id", "_record_hash"}
    assert bronze.where("cd_operadora = ' 1 '").count() == 1  # raw strings kept verbatim

    write(os.path.join(root, "202402"), "b.csv", [("202402", "3", "1")])
    q = start_bronze_stream(spark, root, HEADER, table, checkpoint=ckpt)
    q.awaitTermination(120)
    bronze = spark.table(table)
    assert bronze.count() == 3
    assert bronze.select("_source_path").distinct().count() == 2
    assert bronze.select("_batch_id").distinct().count() == 2


def test_a_repeated_epoch_leaves_its_rows_once_and_other_headers_are_refused(spark, tmp_path):
    root, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    table = f"s_{uuid.uuid4().hex[:6]}.bronze"
    write(root, "a.csv", [("202401", "1", "5"), ("202401", "2", "7")])
    start_bronze_stream(spark, root, HEADER, table, checkpoint=ckpt).awaitTermination(120)
    for commit in (tmp_path / "ckpt" / "commits").iterdir():  # as if the driver had died before it
        commit.unlink()
    start_bronze_stream(spark, root, HEADER, table, checkpoint=ckpt).awaitTermination(120)
    assert spark.table(table).count() == 2
    with open(os.path.join(root, "b.csv"), "w") as f:
        f.write("CD_OPERADORA;ID_CMPT_MOVEL;QT_BENEFICIARIO_ATIVO\n9;202402;1\n")
    query = start_bronze_stream(spark, root, HEADER, table, checkpoint=ckpt)
    with pytest.raises(Exception):
        query.awaitTermination(120)
    assert spark.table(table).count() == 2
