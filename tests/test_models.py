import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logvigil.operators import attribution, chain, models
from logvigil.plans import catalog_models, derived
from logvigil.plans.catalog_models import IMPORTANCES

XY = ("x", "y", "z")


@pytest.fixture(scope="module")
def cloud(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(0, 1), rng.gauss(5, 2), 1.0) for i in range(600)] + [(900 + i, 12.0 + i, -20.0, 1.0) for i in range(5)]
    return spark.createDataFrame(rows, "event_id long, x double, y double, z double").repartition(3)


def test_isolation_forest_ranks_outliers_first(cloud):
    normal = cloud.where("event_id < 900")
    forest = models.isolation_forest_fit(normal, XY, trees=30)
    leaves = forest[forest["feature"] < 0]
    # a tree has no more leaves than different rows; 600 rows dealt in steps of 30 would give it 20
    assert leaves.groupby("tree").size().min() > 20
    assert forest["tree"].nunique() == 30 and forest.groupby("tree").size().max() <= 511
    scored = models.isolation_forest_score(cloud, forest, XY)
    top = [r["event_id"] for r in scored.orderBy(F.col("iforest_score").desc()).limit(5).collect()]
    assert min(top) >= 900
    ends = scored.agg(F.min("iforest_score"), F.max("iforest_score")).first()
    assert 0 < ends[0] < ends[1] <= 1
    again = models.isolation_forest_fit(normal.repartition(5), XY, trees=30)
    assert forest.sort_values(["tree", "node"]).reset_index(drop=True).equals(again.sort_values(["tree", "node"]).reset_index(drop=True))


def test_one_class_follows_the_kernel_mean(cloud):
    """Close to minus the exact mean kernel value, and outliers among the highest scores."""
    normal = cloud.where("event_id < 900")
    got = {r["event_id"]: r["one_class_score"] for r in models.one_class_score(cloud, models.one_class_fit(normal, XY)).collect()}
    points = cloud.toPandas().set_index("event_id")[["x", "y"]]
    train = points[points.index < 900]
    scaled = (points - train.mean()) / train.std(ddof=0)
    base = scaled[scaled.index < 900].to_numpy()
    for event_id, point in scaled.iterrows():
        exact = -np.exp(-0.5 * ((base - point.to_numpy()) ** 2).sum(axis=1)).mean()
        assert abs(got[event_id] - exact) < 0.15
    ranked = sorted(got, key=got.get, reverse=True)
    assert {900, 901, 902, 903, 904} <= set(ranked[:30])


@pytest.fixture(scope="module")
def alerts(spark):
    return derived.alerts(spark, "/root/testdata/sf0.001")


def test_classifier_rules_and_folds(alerts):
    rows = alerts.drop("predicted_attack_type", "prediction_source")
    model = models.classifier_fit(rows, chain.FEATURES, trees=10)
    assert models.class_names(model) == sorted(r["target_class"] for r in rows.select("target_class").distinct().collect())
    assert sum(models.importances(model, chain.FEATURES).values()) == pytest.approx(1.0)
    got = models.predict(rows, model).collect()
    assert len(got) == rows.count() and all(0 < r["confidence"] <= 1 for r in got)
    for r in got:
        if r["geo_velocity_kmh"] > 900 and r["geo_distance_prev_km"] > 500:
            assert (r["predicted_attack_type"], r["confidence"]) == ("impossible_travel", 1.0)
    right = sum(r["predicted_attack_type"] == r["target_class"] for r in got)
    assert right / len(got) > 0.8
    held = models.cv_oof(rows, chain.FEATURES, folds=2, trees=5)
    assert held.count() == rows.count() == held.select("event_id").distinct().count()


def test_boosted_classifier(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(3 * (i % 3), 1), "abc"[i % 3], 0.0, 0.0, 0) for i in range(90)]
    df = spark.createDataFrame(rows, "event_id long, x double, target_class string, geo_velocity_kmh double, geo_distance_prev_km double, failed_auth_count_5min long")
    model = models.classifier_fit(df, ("x",), depth=2, boosted=True, rounds=3)
    got = models.predict(df, model).collect()
    assert sum(r["predicted_attack_type"] == r["target_class"] for r in got) > 60
    assert all(r["confidence"] is None for r in got)


def test_boosted_query_boosts_all_rounds(spark, monkeypatch):
    """As many rounds a class as the original has, however the rows lie."""
    rows = [(i, "ab"[i % 2], *[float(i % 2)] * len(chain.FEATURES)) for i in range(24)]
    flagged = spark.createDataFrame(rows, ["event_id", "target_class", *chain.FEATURES]).repartition(5, "event_id")
    fit, fitted = models.classifier_fit, []
    monkeypatch.setattr(models, "classifier_fit", lambda *args, **kwargs: fitted.append(fit(*args, **kwargs)) or fitted[-1])
    monkeypatch.setattr(derived, "flagged", lambda spark, sf: flagged)
    got = catalog_models.threat_classifier_boosted(spark, "").collect()
    assert len(got) == 24 and all(r["predicted_attack_type"] == r["target_class"] for r in got)
    assert [m.getNumTrees for m in fitted[0].stages[2].models] == [200, 200]


def test_card_contract(spark, alerts):
    events = derived.access_log(spark, "/root/testdata/sf0.001")
    cards = attribution.explain_cards(alerts, events, IMPORTANCES).collect()
    assert len(cards) == alerts.count()
    for card in cards:
        assert 0.0 <= card["risk_score"] <= 1.0 and isinstance(card["cold_start"], bool) and card["attack_type"]
        assert len({r["feature"] for r in card["reasons"]}) == 3 and all(r["narrative"] for r in card["reasons"])
        history = card["entity_history_snippet"]
        assert 1 <= len(history) <= 5 and history[-1]["event_id"] == str(card["event_id"])
        assert [h["timestamp"] for h in history] == sorted(h["timestamp"] for h in history)


def test_rule_reasons_come_first(log):
    base = {f: 0.0 for f in chain.FEATURES}
    row = log([{}]).withColumns({f: F.lit(v) for f, v in base.items()})
    row = row.withColumns({"session_duration": F.lit(9.0), "geo_velocity_kmh": F.lit(950.0), "geo_distance_prev_km": F.lit(600.0), "failed_auth_count_5min": F.lit(31)})

    def reasons(attack):
        got = attribution.with_reasons(row.withColumn("predicted_attack_type", F.lit(attack)), dict.fromkeys(chain.FEATURES, 0.1)).first()
        return [r["feature"] for r in got["reasons"]]

    assert reasons("impossible_travel") == ["geo_velocity_kmh", "geo_distance_prev_km", "failed_auth_count_5min"]
    assert reasons("brute_force") == ["failed_auth_count_5min", "geo_velocity_kmh", "geo_distance_prev_km"]
    assert reasons("unknown") == ["geo_velocity_kmh", "geo_distance_prev_km", "failed_auth_count_5min"]


def test_sequence_part_of_the_weight(log):
    row = log([{}]).withColumns({f: F.lit(1.0) for f in chain.FEATURES}).withColumn("rec_err_duration", F.lit(10.0))
    got = {r["feature"]: r["weight"] for r in attribution.combined_attribution(row, dict.fromkeys(chain.FEATURES, 0.5)).collect()}
    assert got["session_duration"] == pytest.approx(0.6 * 0.5 + 0.4 * 10)
    assert got["norm_session_duration"] == got["session_duration"]
    assert got["rec_err_duration"] == pytest.approx(0.6 * 5) and got["day_of_week"] == pytest.approx(0.3)
    assert got["hour_of_day"] == pytest.approx(0.6 * 0.5 + 0.4 * 1)
