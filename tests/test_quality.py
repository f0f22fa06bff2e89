import pytest
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key, first_not_null, latest_batch_id
from strata.operators.quality import any_null, ensure_not_empty, missing_reason, require_columns
from strata.plans import silver
from strata.queries import Layers
from tests.conftest import SF_SMALL


def test_any_null_and_missing_reason(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("a", "b")], "x string, y string")
    rows = df.select(any_null(["x", "y"]), missing_reason(["x", "y"])).collect()
    assert [tuple(r) for r in rows] == [
        (True, "y ausente"), (True, "x ausente; y ausente"), (False, None)
    ]
    assert df.select(any_null([])).first()[0] is False


def test_require_columns(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError, match=r"\['y', 'z'\]"):
        require_columns(df, ["z", "x", "y"])


def test_ensure_not_empty(spark):
    with pytest.raises(ValueError):
        ensure_not_empty(spark.range(0), "nothing")


def test_valid_plus_rejected_is_input(spark):
    layers = Layers(spark, SF_SMALL)
    total = layers.cleaned.count()
    valid = layers.valid.count()
    rejected = layers.s_rejected.count()
    assert valid + rejected == total
    assert rejected > 0 and valid > 0


def test_every_rule_fires_on_the_fixture(spark):
    layers = Layers(spark, SF_SMALL)
    counts = layers.classified.select(
        F.explode(F.split("_rejection_reason", "; ")).alias("r")
    ).groupBy("r").count().collect()
    reasons = {r["r"] for r in counts}
    for rule in silver.movement_rules():
        if "cancelado" in rule.reason or "aderido" in rule.reason:
            continue  # the fixture never makes those counts negative
        assert rule.reason in reasons, rule.reason


def test_dedupe_keeps_latest_and_unique_keys(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 3, "b"), ("k", None, "c"), ("j", None, "d")], "k string, o int, v string"
    )
    out = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["o"]).collect()}
    assert out == {"k": "b", "j": "d"}
    with pytest.raises(ValueError, match="key columns"):
        latest_per_key(df, ["nope"], ["o"])
    with pytest.raises(ValueError, match="order columns"):
        latest_per_key(df, ["k"], ["nope"])


def test_silver_keys_unique_and_reload_wins(spark):
    layers = Layers(spark, SF_SMALL)
    m = layers.s_movement
    assert m.count() == m.select(*silver.MOVEMENT_KEY).distinct().count()
    reloads = m.where(F.col("_source_path").startswith("raw/reload/"))
    assert reloads.count() > 0
    assert reloads.where(F.dayofmonth("dt_carga") != 20).count() == 0


def test_first_not_null_is_deterministic(spark):
    df = spark.createDataFrame([("g", None, "1"), ("g", "x", "3"), ("g", "y", "2")], "g string, v string, o string")
    assert df.groupBy("g").agg(first_not_null("v", "o")).first()["v"] == "y"


def test_latest_batch_id(spark):
    df = spark.createDataFrame([("b1",), ("b3",), (None,)], "_batch_id string")
    assert latest_batch_id(df) == "b3"
    with pytest.raises(ValueError):
        latest_batch_id(spark.createDataFrame([(None,)], "_batch_id string"))


def test_every_fact_key_resolves_in_its_dimension(spark):
    layers = Layers(spark, SF_SMALL)
    for dim, sk in [(layers.d_insurer, "sk_operadora"), (layers.d_municipality, "sk_municipio"),
                    (layers.d_plan, "sk_plano"), (layers.d_profile, "sk_perfil_beneficiario")]:
        assert dim.count() == dim.select(sk).distinct().count()
        assert layers.fact.join(dim, sk, "left_anti").count() == 0, sk
