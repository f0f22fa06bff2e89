import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans import tables
from strata.session import run_sql


def name(prefix):
    return f"t_{prefix}_{uuid.uuid4().hex[:8]}"


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_namespace_and_exists(spark):
    db = name("db")
    tables.ensure_namespace(spark, db)
    assert spark.catalog.databaseExists(db)
    assert not tables.table_exists(spark, f"{db}.missing")


def test_append_creates_then_appends_by_name(spark):
    t = f"{name('ns')}.app"
    df = spark.createDataFrame([("a", 1)], "k string, x int")
    tables.append(df, t)
    tables.append(df.select("x", "k"), t)
    assert content(spark, t) == [("a", 1), ("a", 1)]


def test_merge_table_runs_twice_like_once(spark):
    t = f"{name('ns')}.merge"
    base = spark.createDataFrame([("a", "1", "h1"), ("b", "2", "h2")], "k string, v string, _record_hash string")
    tables.merge_table(base, t, ["k"])
    src = spark.createDataFrame([("a", "9", "h9"), ("c", "3", "h3")], "k string, v string, _record_hash string")
    tables.merge_table(src, t, ["k"])
    first = content(spark, t)
    tables.merge_table(src, t, ["k"])
    assert content(spark, t) == first == [("a", "9", "h9"), ("b", "2", "h2"), ("c", "3", "h3")]


def test_replace_table_rewrites_only_touched_partitions(spark):
    t = f"{name('ns')}.rep"
    base = spark.createDataFrame([(1, "m1"), (2, "m1"), (3, "m2")], "x int, m string")
    tables.replace_table(base, t, ["m"])
    assert tables.partition_columns(spark, t) == ["m"]
    m2_files = sorted(spark.table(t).where(F.col("m") == "m2").inputFiles())
    tables.replace_table(spark.createDataFrame([(10, "m1")], "x int, m string"), t, ["m"])
    assert content(spark, t) == [(3, "m2"), (10, "m1")]
    assert sorted(spark.table(t).where(F.col("m") == "m2").inputFiles()) == m2_files
    # an empty source still clears the partitions named explicitly
    tables.replace_table(spark.createDataFrame([], "x int, m string"), t, ["m"], values=[{"m": "m1"}])
    assert content(spark, t) == [(3, "m2")]


def test_inspect_layer(spark):
    db = name("insp")
    tables.append(spark.createDataFrame([(i,) for i in range(20)], "x int"), f"{db}.t1")
    names, sample = tables.inspect_layer(spark, db, "t1", n=10)
    assert names == ["t1"]
    assert sample.count() == 10


BASE = [("a", "1", "h1"), ("b", "2", "h2")]
NEW = [("a", "9", "h9"), ("c", "3", "h3")]
AFTER = [("a", "9", "h9"), ("b", "2", "h2"), ("c", "3", "h3")]
ROW = "k string, v string, _record_hash string"


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", range(4))
def test_a_swap_that_fails_at_any_step_loses_nothing(spark, monkeypatch, step):
    t = f"{name('ns')}.swap"
    tables.merge_table(spark.createDataFrame(BASE, ROW), t, ["k"])
    source = spark.createDataFrame(NEW, ROW)
    calls = []

    def failing(real):
        def call(*args, **kwargs):
            calls.append(real.__name__)
            if len(calls) > step:
                raise Crash
            return real(*args, **kwargs)

        return call

    with monkeypatch.context() as patched:
        for function in ("create_table", "_rename", "_drop"):
            patched.setattr(tables, function, failing(getattr(tables, function)))
        with pytest.raises(Crash):
            tables.merge_table(source, t, ["k"])
    tables.recover(spark, t)
    assert content(spark, t) in (sorted(BASE), AFTER)
    tables.merge_table(source, t, ["k"])
    assert content(spark, t) == AFTER
    namespace, _, table = t.partition(".")
    assert [x.name for x in spark.catalog.listTables(namespace)] == [table]


def test_merge_rewrites_only_the_partitions_of_the_source(spark):
    t = f"{name('ns')}.part"
    schema = "m string, k string, v string, _record_hash string"
    rows = [("m1", "a", "1", "h1"), ("m2", "a", "1", "h1"), (None, "n", "1", "h1")]
    tables.merge_table(spark.createDataFrame(rows, schema), t, ["m", "k"], partition_by=["m"])
    before = sorted(spark.table(t).where("m = 'm2'").inputFiles())
    source = [("m1", "a", "2", "h2"), ("m1", "b", "2", "h2"), ("m3", "c", "3", "h3")]
    tables.merge_table(spark.createDataFrame(source, schema), t, ["m", "k"], partition_by=["m"])
    got = sorted(tuple(r) for r in spark.table(t).select("m", "k", "v").where("m is not null").collect())
    assert got == [("m1", "a", "2"), ("m1", "b", "2"), ("m2", "a", "1"), ("m3", "c", "3")]
    assert spark.table(t).where("m is null").count() == 1
    assert sorted(spark.table(t).where("m = 'm2'").inputFiles()) == before


def test_replace_refuses_other_partitioning_and_odd_values(spark):
    t = f"{name('ns')}.odd"
    rows = spark.createDataFrame([(1, "it's"), (2, "b\\\\c")], "x int, m string")
    tables.replace_table(rows, t, ["m"])
    with pytest.raises(ValueError, match="partitioned by"):
        tables.replace_table(rows, t, ["x"])
    tables.replace_table(rows.where("x > 9"), t, ["m"], values=[{"m": "it's"}])
    assert [r.x for r in spark.table(t).collect()] == [2]


def test_duplicate_source_keys_leave_the_table_as_it_is(spark):
    t = f"{name('ns')}.dup"
    tables.merge_table(spark.createDataFrame(BASE, ROW), t, ["k"])
    with pytest.raises(Exception, match="duplicate keys"):
        tables.merge_table(spark.createDataFrame(NEW + NEW[:1], ROW), t, ["k"])
    tables.recover(spark, t)
    assert content(spark, t) == sorted(BASE)


def test_few_files_per_partition(spark):
    t = f"{name('ns')}.files"
    rows = spark.range(0, 4000, 1, 16).selectExpr("id", "cast(id % 12 as string) as m")
    tables.replace_table(rows, t, ["m"])
    assert len(spark.table(t).inputFiles()) == 12


def test_names_and_locations(spark, tmp_path):
    db = name("loc")
    tables.create_table(spark.createDataFrame(BASE, ROW), f"spark_catalog.{db}.t", storage=tables.Storage(location=f"file://{tmp_path}/{db}"))
    assert spark.catalog.databaseExists(f"spark_catalog.{db}")
    assert content(spark, f"spark_catalog.{db}.t") == sorted(BASE)
    assert f"{tmp_path}/{db}" in spark.table(f"{db}.t").inputFiles()[0]
    with pytest.raises(Exception):
        tables.ensure_namespace(spark, f"no_such_catalog.{db}")
    assert [r.k for r in run_sql(spark, f"SELECT k FROM {db}.t WHERE v > :least ORDER BY k", limit=1, least="0").collect()] == ["a"]


class Recorder:
    """Stands in for the row-level writers, whose catalogs do not ship with Spark."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, method):
        def call(*args):
            self.calls.append((method, *map(str, args)))
            return self

        return call


def test_row_level_storage_writes_and_merges_by_the_catalog(spark, monkeypatch):
    t = f"{name('ns')}.rows"
    tables.append(spark.createDataFrame(BASE, ROW), t)
    seen = Recorder()
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "writeTo", lambda self, table: seen.writeTo(table))
    monkeypatch.setattr(frame, "mergeInto", lambda self, table, on: seen.mergeInto(table, on))
    storage = tables.Storage(format="iceberg", row_level=True)
    tables.create_table(spark.createDataFrame(NEW, ROW), f"{t}_2", ["k"], storage)
    tables.append(spark.createDataFrame(NEW, ROW), t, None, storage)
    tables.merge_table(spark.createDataFrame(NEW, ROW), t, ["k"], storage=storage)
    tables.replace_table(spark.createDataFrame(NEW, ROW), t, ["k"], storage=storage)
    methods = [c[0] for c in seen.calls]
    assert methods == [
        "writeTo", "using", "partitionedBy", "create", "writeTo", "append",
        "mergeInto", "whenMatched", "update", "whenNotMatched", "insertAll", "merge", "writeTo", "overwritePartitions",
    ]
    assert seen.calls[1] == ("using", "iceberg") and seen.calls[6][1] == t
    assert "_record_hash" in seen.calls[7][1] and "'v'" in seen.calls[8][1] and "'k'" not in seen.calls[8][1]


def bucketed(spark, monkeypatch=None, n=400):
    t = f"{name('ns')}.bucketed"
    rows = [(f"k{i}", f"v{i}", f"h{i}") for i in range(n)] + [(None, "null key", "h")]
    tables.merge_table(spark.createDataFrame(rows, ROW), t, ["k"], buckets=16)
    return t


def files_by_bucket(spark, t):
    found = {}
    for f in spark.table(t).inputFiles():
        found.setdefault(f.split(f"{tables.BUCKET}=")[1].split("/")[0], set()).add(f)
    return found


def test_a_merge_in_buckets_rewrites_those_with_changes_in_one_commit(spark, monkeypatch):
    t = bucketed(spark)
    assert sorted(tables.rows_of(spark, t).columns) == sorted(["k", "v", "_record_hash"]) and tables.rows_of(spark, t).count() == 401
    before = files_by_bucket(spark, t)
    assert len(before) == 16

    def never(*args, **kwargs):
        raise AssertionError("the table must not disappear")

    for step in ("_rename", "_drop", "_swap"):
        monkeypatch.setattr(tables, step, never)
    same = [(f"k{i}", f"v{i}", f"h{i}") for i in range(50, 100)]  # nothing new in these
    tables.merge_table(spark.createDataFrame([*same, ("k7", "new", "h-new"), (None, "other", "h-other")], ROW), t, ["k"])
    after = files_by_bucket(spark, t)
    changed = {r[0] for r in spark.table(t).where("k = 'k7' or k is null").select(tables.BUCKET).collect()}
    assert {b for b in before if after[b] != before[b]} == {str(b) for b in changed}
    got = {r["k"]: (r["v"], r["_record_hash"]) for r in tables.rows_of(spark, t).collect()}
    assert len(got) == 401 and got["k7"] == ("new", "h-new") and got[None] == ("other", "h-other") and got["k8"] == ("v8", "h8")
    tables.merge_table(spark.createDataFrame([("k7", "new", "h-new"), *same], ROW), t, ["k"])
    assert files_by_bucket(spark, t) == after  # a repeated merge writes nothing


def test_a_merge_in_buckets_equals_the_pure_merge(spark):
    from strata.operators.merge import merge_frames

    t = f"{name('ns')}.same"
    base = spark.createDataFrame([(i, f"v{i}", None if i % 5 == 0 else f"h{i}") for i in range(60)], "k long, v string, _record_hash string")
    source = spark.createDataFrame([(i, f"n{i}", None if i % 7 == 0 else f"h{i + i % 2}") for i in range(30, 90)], base.schema)
    tables.merge_table(base, t, ["k"], buckets=8)
    tables.merge_table(source, t, ["k"], non_update=["v"])
    wanted = sorted(tuple(r) for r in merge_frames(base, source, ["k"], non_update=["v"]).collect())
    assert sorted(tuple(r) for r in tables.rows_of(spark, t).collect()) == wanted


def test_a_merge_in_buckets_that_fails_leaves_the_table_as_it_was(spark, monkeypatch):
    t = bucketed(spark)
    before = files_by_bucket(spark, t)
    with pytest.raises(Exception, match="duplicate keys"):
        tables.merge_table(spark.createDataFrame([("k1", "a", "x"), ("k1", "b", "y")], ROW), t, ["k"])
    with monkeypatch.context() as patched:

        def crash(*args):
            raise Crash

        patched.setattr(tables, "_overwrite_partitions", crash)
        with pytest.raises(Crash):
            tables.merge_table(spark.createDataFrame([("k1", "a", "x")], ROW), t, ["k"])
    assert files_by_bucket(spark, t) == before
    tables.merge_table(spark.createDataFrame([("k1", "a", "x")], ROW), t, ["k"])
    assert tables.rows_of(spark, t).where("k = 'k1'").first()["v"] == "a"


def test_buckets_are_by_the_keys_of_the_first_merge(spark):
    t = bucketed(spark)
    with pytest.raises(ValueError, match="not by"):
        tables.merge_table(spark.createDataFrame(NEW, ROW), t, ["v"])


@pytest.mark.parametrize("parts, values", [(["m"], [("m1",), (None,)]), (["m"], [("m1",)]), (["m", "n"], [("m1", 1), (None, 2)])])
def test_a_merge_reads_only_the_partitions_of_its_source(spark, parts, values):
    t = f"{name('ns')}.pruned"
    rows = [(m, n, f"{m}{n}") for m in ("m1", "m2", None) for n in (1, 2)]
    tables.create_table(spark.createDataFrame(rows, "m string, n int, k string"), t, parts)
    found = tables.partitions_of(spark.table(t), parts, values)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "m1" in filters
    kept = {r["k"] for r in found.collect()}
    assert kept == {k for m, n, k in rows if tuple({"m": m, "n": n}[c] for c in parts) in values}
    assert not [f for f in found.inputFiles() if "m=m2" in f]


def test_cleared_partitions_go_in_one_catalog_change(spark, monkeypatch):
    t = f"{name('ns')}.clear"
    tables.replace_table(spark.createDataFrame([(i, f"m{i}") for i in range(5)], "x int, m string"), t, ["m"])
    statements = []
    session = type(spark)
    monkeypatch.setattr(session, "sql", lambda self, q, *a, real=session.sql, **k: statements.append(q) or real(self, q, *a, **k))
    source = spark.createDataFrame([(9, "m1")], "x int, m string")
    tables.replace_table(source, t, ["m"], values=[{"m": "m1"}, {"m": "m2"}, {"m": "m3"}, {"m": "none"}])
    assert sum("DROP IF EXISTS" in q for q in statements) == 1
    assert content(spark, t) == [(0, "m0"), (4, "m4"), (9, "m1")]


def test_appends_into_partitions_have_folders_of_their_own(spark):
    t = f"{name('ns')}.parts"
    for batch in ("b1", "b2", "b1"):
        tables.append(spark.createDataFrame([(1,)], "x int").withColumn("b", F.lit(batch)), t, ["b"], into={"b": batch})
    assert content(spark, t) == [(1, "b1"), (1, "b1"), (1, "b2")]
    with pytest.raises(ValueError, match="folder"):
        tables.append(spark.createDataFrame([(1, "../x")], "x int, b string"), t, ["b"], into={"b": "../x"})
