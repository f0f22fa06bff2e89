"""Loads side by side, loads that fail, malformed lines, closed periods: what is kept, counted and cleared."""

import datetime

import pytest
from pyspark.sql import functions as F

from strata.plans import layers, ledger, reports, silver, tables
from strata.sources import csv
from strata.streaming.bronze_stream import start_bronze_stream
from tests.test_layers import HEADER, VALUES, names, write

NOW = datetime.timedelta(0)


def rows(spark, table):
    return spark.table(table).count()


def test_a_load_leaves_streamed_batches_and_skips_their_files(spark, tmp_path):
    own, raw = names(), tmp_path / "raw"
    write(raw / "202401", "a.csv")
    write(raw / "202401", "b.csv", CD_OPERADORA="11")
    start_bronze_stream(spark, str(raw), HEADER, own.bronze, checkpoint=str(tmp_path / "ckpt"), names=own).awaitTermination(120)
    assert rows(spark, own.bronze) == 2
    write(tmp_path / "other", "c.csv")
    assert layers.load_bronze(spark, f"file://{tmp_path}/other", own, stale_after=NOW)["rows"] == 1
    assert rows(spark, own.bronze) == 3  # the streamed rows are still there
    write(raw / "202402", "d.csv")
    assert layers.load_bronze(spark, f"file://{raw}", own)["files"] == 1  # only the one the stream has not brought
    start_bronze_stream(spark, str(raw), HEADER, own.bronze, checkpoint=str(tmp_path / "ckpt"), names=own).awaitTermination(120)
    assert rows(spark, own.bronze) == 4  # nor does the stream bring what the load has
    states = {r["_batch_id"]: (r["state"], r["n_rows"]) for r in ledger.batches(spark, own.loads).collect()}
    assert sorted(states.values()) == [("finished", 0), ("finished", 1), ("finished", 1), ("finished", 2)]


def test_two_loads_at_once_do_not_drop_each_other(spark, tmp_path, monkeypatch):
    own = names()
    write(tmp_path / "one", "a.csv")
    write(tmp_path / "two", "b.csv")
    real, inner = layers._load_files, []

    def meanwhile(*args):
        counts = real(*args)
        if not inner:  # the first load has written its rows, but not its ledger
            inner.append(None)
            inner[0] = layers.load_bronze(spark, f"file://{tmp_path}/two", own)
        return counts

    monkeypatch.setattr(layers, "_load_files", meanwhile)
    outer = layers.load_bronze(spark, f"file://{tmp_path}/one", own)
    assert outer["rows"] == inner[0]["rows"] == 1 and rows(spark, own.bronze) == 2
    assert spark.table(own.files).select("_batch_id").distinct().count() == 2
    assert {r["state"] for r in ledger.batches(spark, own.loads).collect()} == {"finished"}


def test_batches_without_records_stay(spark, tmp_path):
    own = names()
    write(tmp_path / "raw", "a.csv")
    layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    for ledger_table in (own.files, own.loads):
        spark.sql(f"DROP TABLE {ledger_table}")
    write(tmp_path / "more", "b.csv")
    layers.load_bronze(spark, f"file://{tmp_path}/more", own, stale_after=NOW)
    assert rows(spark, own.bronze) == 2


def test_a_killed_load_is_cleared_when_it_is_stale(spark, tmp_path, monkeypatch):
    own = names()
    write(tmp_path / "raw", "a.csv")
    with monkeypatch.context() as patched:

        def killed(*args, **kwargs):
            layers_load(*args, **kwargs)
            raise KeyboardInterrupt  # no handler runs

        layers_load = layers._load_files
        patched.setattr(layers, "_load_files", killed)
        with pytest.raises(KeyboardInterrupt):
            layers.load_bronze(spark, f"file://{tmp_path}/raw", own, batch_id="20260101000000_dead")
    assert rows(spark, own.bronze) == 1
    write(tmp_path / "other", "b.csv")
    layers.load_bronze(spark, f"file://{tmp_path}/other", own)
    assert rows(spark, own.bronze) == 2  # it may still run
    layers.load_bronze(spark, f"file://{tmp_path}/raw", own, stale_after=NOW)
    assert rows(spark, own.bronze) == 2
    assert spark.table(own.bronze).where("_batch_id = '20260101000000_dead'").count() == 0
    found = {r["_batch_id"]: r["state"] for r in ledger.batches(spark, own.loads).collect()}
    assert found["20260101000000_dead"] == "cleared"


def test_latest_load_is_the_one_finished_last(spark, tmp_path):
    own = names()
    for batch in ("stream_x_000000000001", "20260101000000_a"):
        ledger.record(spark, own.loads, batch, ledger.FINISHED, tables.PARQUET, files=1, rows=1, malformed=0)
    ledger.record(spark, own.loads, "20270101000000_b", ledger.STARTED, tables.PARQUET)
    assert ledger.latest_finished(spark, own.loads) == "20260101000000_a"


def test_counters_are_observed_and_equal_the_scan(spark, tmp_path):
    own = names()
    for k, n in enumerate((3, 0, 2)):
        (tmp_path / "raw").mkdir(exist_ok=True)
        lines = [";".join(VALUES[h] for h in HEADER)] * n
        (tmp_path / "raw" / f"{k}.csv").write_text("\n".join([";".join(HEADER), *lines]) + "\n")
    got = layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    assert (got["files"], got["rows"], got["malformed"]) == (2, 5, 0)  # a file with a header alone has no rows
    scanned = reports.batch_audit(spark.table(own.bronze)).collect()
    assert [tuple(r) for r in ledger.audit(spark, own.loads).collect()] == [tuple(r) for r in scanned]


def test_a_load_reads_its_lines_once(spark, tmp_path, monkeypatch):
    """The batch is not read after it was written, and its plan scans the raw lines once."""
    own, plans = names(), []
    write(tmp_path / "raw", "a.csv")
    real = tables.append

    def seen(df, name, *args):
        if name == own.bronze:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, *args)

    monkeypatch.setattr(tables, "append", seen)
    session = type(spark)
    read = []
    monkeypatch.setattr(session, "table", lambda self, name, real=session.table: read.append(name) or real(self, name))
    layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    assert len(plans) == 1 and plans[0].count("FileScan text") == 1
    assert read.count(own.bronze) <= 1  # its schema, for the order of columns


def lines_of(*cells):
    base = [VALUES[h] for h in HEADER]
    return [";".join(base[: len(base) + c] if c <= 0 else [*base, *["more"] * c]) for c in cells]


def malformed_folder(tmp_path):
    """One good line, one with a cell missing, one with two too many, a valid and a rejected one; and a file of another header."""
    folder = tmp_path / "raw" / "202401"
    folder.mkdir(parents=True)
    bad = dict(VALUES, SG_UF="??")
    text = [";".join(HEADER), *lines_of(0, -1, 2), ";".join(bad[h] for h in HEADER)]
    (folder / "a.csv").write_text("\n".join(text) + "\n")
    turned = HEADER[::-1]
    (folder / "b.csv").write_text(";".join(turned) + "\n" + ";".join(VALUES[h] for h in turned) + "\nonly;two\n")
    return f"file://{tmp_path}/raw"


@pytest.mark.parametrize("mode", ["quarantine", "keep"])
def test_every_line_is_valid_rejected_or_malformed(spark, tmp_path, mode):
    own = names()
    got = layers.load_bronze(spark, malformed_folder(tmp_path), own, malformed=mode)
    assert (got["files"], got["malformed"]) == (2, 3)
    seen = {(r["_source_path"][-5:], r["linha"]) for r in spark.table(own.malformed).collect()}
    assert seen == {("a.csv", lines_of(-1)[0]), ("a.csv", lines_of(2)[0]), ("b.csv", "only;two")}
    assert got["rows"] == (3 if mode == "quarantine" else 6)
    batch = layers.load_silver(spark, own)
    classified = silver.classify_movement(silver.clean_movement(spark.table(own.bronze), batch_id=batch))
    valid, rejected = silver.valid_movement(classified).count(), rows(spark, own.rejected)
    total = valid + rejected + (got["malformed"] if mode == "quarantine" else 0)
    assert total == 6
    assert (valid, rejected) == ((2, 1) if mode == "quarantine" else (3, 3))  # a line cut short has no load date


def test_a_cleared_batch_loses_its_malformed_lines_too(spark, tmp_path, monkeypatch):
    own, folder = names(), malformed_folder(tmp_path)
    real = tables.append

    def failing(df, name, *args):
        if name == own.files:
            raise RuntimeError("lost")
        return real(df, name, *args)

    with monkeypatch.context() as patched:
        patched.setattr(tables, "append", failing)
        with pytest.raises(RuntimeError):
            layers.load_bronze(spark, folder, own)
    layers.load_bronze(spark, folder, own)
    assert (rows(spark, own.bronze), rows(spark, own.malformed)) == (6, 3)


def test_all_headers_are_checked_before_a_row_is_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "FILES_AT_ONCE", 1)
    own = names()
    write(tmp_path / "raw", "a.csv")
    write(tmp_path / "raw", "b.csv", [*HEADER, "NEW"])
    with pytest.raises(ValueError, match="outside the contract"):
        layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    assert not tables.table_exists(spark, own.bronze)
    # a column that only some files have is NULL in the rows of the others, whatever pass they fall into
    write(tmp_path / "some", "a.csv", HEADER[:-1])
    write(tmp_path / "some", "b.csv")
    assert layers.load_bronze(spark, f"file://{tmp_path}/some", own)["rows"] == 2
    assert spark.table(own.bronze).where("dt_carga is null").count() == 1


def test_hundreds_of_headers(spark, tmp_path):
    """Headers are data, not branches of the plan."""
    n = 300
    for i in range(n):
        turned = HEADER[i % len(HEADER) :] + HEADER[: i % len(HEADER)]
        write(tmp_path / "raw", f"{i}.csv", [*turned, f"EXTRA_{i}"][: len(HEADER) + i % 2], CD_OPERADORA=str(i))
    raw = csv.read_csv(spark, f"file://{tmp_path}/raw")
    assert raw.select("cd_operadora", "dt_carga").distinct().count() == n
    plan = raw.select("cd_operadora")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") <= 4


def test_closed_periods_are_not_listed(spark, tmp_path, monkeypatch):
    own, root = names(), tmp_path / "raw"
    periods = [f"{1900 + i // 12}{i % 12 + 1:02d}" for i in range(1000)]
    for period in periods:
        (root / period).mkdir(parents=True)
    write(root / "202401", "a.csv")
    write(root / "extra", "b.csv")
    ledger.close_periods(spark, own.closed, periods[:500], tables.PARQUET)
    ledger.close_periods(spark, own.closed, periods, tables.PARQUET)
    assert rows(spark, own.closed) == 1000
    listed = []
    real = csv.list_files
    monkeypatch.setattr(layers, "list_files", lambda spark, folders: listed.append(folders) or real(spark, folders))
    assert layers.load_bronze(spark, f"file://{root}", own)["files"] == 2
    assert sorted(f.rpartition("/")[2] for f in listed[0]) == ["202401", "extra"]
    write(root / periods[7], "late.csv")
    assert layers.load_bronze(spark, f"file://{root}", own)["files"] == 0
    assert layers.load_bronze(spark, f"file://{root}", own, closed_periods="list")["files"] == 1
    ledger.close_periods(spark, own.closed, ["202401"], tables.PARQUET)
    (root / "extra" / "b.csv").unlink()
    (root / "extra").rmdir()
    assert layers.load_bronze(spark, f"file://{root}", own)["files"] == 0  # nothing is left to list


def test_a_run_without_changes_writes_no_entity_and_no_dimension(spark, tmp_path):
    own = names()
    write(tmp_path / "raw", "a.csv")
    write(tmp_path / "raw", "b.csv", CD_OPERADORA="11", NM_RAZAO_SOCIAL="OTHER", CD_MUNICIPIO="355031", CD_PLANO="8")
    layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    layers.load_silver(spark, own)
    layers.load_gold(spark, own)
    kept = [own.insurer, own.municipality, own.plan, own.dim_insurer, own.dim_municipality, own.dim_plan, own.dim_profile]
    before = {t: sorted(spark.table(t).inputFiles()) for t in kept}
    layers.load_silver(spark, own)
    layers.load_gold(spark, own)
    assert {t: sorted(spark.table(t).inputFiles()) for t in kept} == before
    write(tmp_path / "raw", "c.csv", CD_OPERADORA="11", NM_RAZAO_SOCIAL="NEW NAME", CD_MUNICIPIO="355031", CD_PLANO="8", DT_CARGA="2024-02-01")
    layers.load_bronze(spark, f"file://{tmp_path}/raw", own)
    layers.load_silver(spark, own)
    layers.load_gold(spark, own)
    after = {t: sorted(spark.table(t).inputFiles()) for t in kept}
    assert len(set(before[own.dim_insurer]) - set(after[own.dim_insurer])) == 1  # the bucket of the changed insurer
    assert {r["nm_razao_social"] for r in spark.table(own.dim_insurer).collect()} == {"ACME", "NEW NAME"}
    for sk, dim in (("sk_operadora", own.dim_insurer), ("sk_municipio", own.dim_municipality), ("sk_plano", own.dim_plan)):
        assert spark.table(own.fact).join(spark.table(dim), sk, "left_anti").count() == 0
    assert tables.BUCKET not in tables.rows_of(spark, own.dim_plan).columns
    assert spark.table(own.fact).agg(F.count("*")).first()[0] >= 1
