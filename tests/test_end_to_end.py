import tempfile
import uuid

from pyspark.sql import functions as F

from strata.plans import layers, reports
from strata.queries import DISPLAY_HEADERS
from strata.sources.csv import write_csv
from strata.sources.fixture import BUSINESS_COLUMNS, raw_movement
from tests.conftest import SF_SMALL


def test_csv_to_report_twice_then_new_batch(spark):
    suffix = uuid.uuid4().hex[:6]
    names = layers.Names(**{k: f"{v.split('.')[0]}_{suffix}.{v.split('.')[1]}"
                            for k, v in layers.Names().__dict__.items()})
    raw = raw_movement(spark, SF_SMALL)
    shown = raw.select(*[F.col(c).alias(DISPLAY_HEADERS[c]) for c in BUSINESS_COLUMNS],
                       F.regexp_extract("_source_path", r"([0-9]{6})", 1).alias("period"))
    folder = tempfile.mkdtemp(prefix="raw-")
    old = shown.where(F.col("period") < "200001")
    write_csv(old, folder + "/part1", partition_by=["period"])

    first = layers.load_bronze(spark, folder, names, batch_id="20260101000000_aaaaaaaa")
    assert first["rows"] == old.count() and first["files"] > 0
    again = layers.load_bronze(spark, folder, names, batch_id="20260101000001_bbbbbbbb")
    assert again["files"] == 0  # nothing new: file-level pruning

    layers.load_silver(spark, names)
    layers.load_gold(spark, names)
    fact = spark.table(names.fact)
    before = sorted(tuple(r) for r in reports.active_by_state(fact, spark.table(names.dim_municipality)).collect())
    rejected_before = spark.table(names.rejected).count()

    # Re-running the same batch changes nothing.
    layers.load_silver(spark, names, batch_id=first["batch_id"])
    layers.load_gold(spark, names)
    assert sorted(tuple(r) for r in reports.active_by_state(spark.table(names.fact),
                                                            spark.table(names.dim_municipality)).collect()) == before
    assert spark.table(names.rejected).count() == rejected_before

    # A second delivery with the newer months is picked up incrementally.
    write_csv(shown.where(F.col("period") >= "200001"), folder + "/part2", partition_by=["period"])
    second = layers.load_bronze(spark, folder, names, batch_id="20260102000000_cccccccc")
    assert second["rows"] == raw.count() - old.count()
    layers.load_silver(spark, names)
    layers.load_gold(spark, names)
    months = spark.table(names.fact).select("id_cmpt_movel").distinct().count()
    assert months == spark.table(names.movement).select("id_cmpt_movel").distinct().count()
    assert spark.table(names.fact).join(spark.table(names.dim_plan), "sk_plano", "left_anti").count() == 0
