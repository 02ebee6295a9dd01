"""The whole chain: from CSV to cards, and with every entity treated as hot."""

import pytest
from pyspark.sql import functions as F

from logvigil import session
from logvigil.functions import rules
from logvigil.operators import attribution, chain, models, scoring, timeline, triage
from logvigil.plans import derived
from logvigil.session import written
from logvigil.sources import readers

SF = "/root/testdata/sf0.001"


def features_of(logs):
    learned = chain.learn(logs)
    return chain.combined_features(learned, written(chain.ensemble_scores(learned)))


def test_hot_entities_change_nothing(spark, monkeypatch):
    columns = ["event_id", *chain.FEATURES, "seq_error", "score", "score_ensemble"]
    plain = features_of(derived.access_log(spark, SF)).select(*columns).toPandas().set_index("event_id").sort_index()
    monkeypatch.setattr(timeline, "HOT_ROWS", 20)
    sliced = features_of(derived.access_log(spark, SF)).select(*columns).toPandas().set_index("event_id").sort_index()
    assert len(plain) == len(sliced) > 500
    for column in columns[1:]:
        assert sliced[column].to_numpy() == pytest.approx(plain[column].to_numpy(), rel=1e-9, abs=1e-9), column


def test_tasks_follow_the_rows(spark, monkeypatch):
    set_for = []

    def noted(df, settings=None):
        set_for.append(spark.conf.get("spark.sql.shuffle.partitions"))
        return written(df, settings)

    columns = ["event_id", *chain.FEATURES, "score_ensemble"]
    few = features_of(derived.access_log(spark, SF)).select(*columns).toPandas().set_index("event_id").sort_index()
    monkeypatch.setattr(session, "ROWS_A_TASK", 90)
    monkeypatch.setattr(chain, "written", noted)
    learned = chain.learn(derived.access_log(spark, SF))
    assert set_for == ["4", "12", "12"]  # the log itself needs no exchange
    rows = chain.ensemble_scores(learned, with_trailing=True)
    assert set(set_for[3:]) == {"12"} and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    many = rows.select(*columns).toPandas().set_index("event_id").sort_index()
    for column in columns[1:]:
        assert many[column].to_numpy() == pytest.approx(few[column].to_numpy(), rel=1e-9, abs=1e-9), column


@pytest.mark.parametrize("hot_rows", [timeline.HOT_ROWS, 20])
def test_one_pass_gives_scores_and_all_features(spark, monkeypatch, hot_rows):
    """Trailing features of the pass that scores are those of a pass over the scored rows, and nothing is shuffled after its write."""
    columns = ["event_id", *chain.FEATURES, "score", "score_ensemble", "score_rolling_ensemble"]
    two = features_of(derived.access_log(spark, SF)).select(*columns).toPandas().set_index("event_id").sort_index()
    monkeypatch.setattr(timeline, "HOT_ROWS", hot_rows)
    learned = chain.learn(derived.access_log(spark, SF))
    scored = chain.ensemble_scores(learned, with_trailing=True)
    rows = chain.combined_features(learned, scored)
    assert rows is scored and "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    one = rows.select(*columns).toPandas().set_index("event_id").sort_index()
    for column in columns[1:]:
        assert one[column].to_numpy() == pytest.approx(two[column].to_numpy(), rel=1e-9, abs=1e-9), column


def test_ensemble_follows_the_base_model_that_wins(spark, monkeypatch):
    """Profile scores that say nothing lose to the trained models, and the ensemble then rests on the winner."""
    learned = chain.learn(derived.access_log(spark, SF))
    plain = chain.base_scores
    monkeypatch.setattr(chain, "base_scores", lambda *args: plain(*args).withColumn("score", F.lit(0.5)))
    scored = written(chain.base_scores(learned))
    rows, model = chain.best_base_scores(scored)
    assert model in ("isolation_forest", "one_class")
    best = {r["event_id"]: r["score"] for r in rows.collect()}
    assert len(set(best.values())) > 100 and set(rows.columns) == set(scored.columns)
    ensemble = chain.ensemble_scores(learned, best_base=True)
    assert {r["event_id"]: r["score"] for r in ensemble.collect()} == pytest.approx(best)
    assert {r["score"] for r in chain.ensemble_scores(learned).collect()} == {0.5}


def test_from_csv_to_cards(spark, tmp_path):
    for name, table in (("logs", derived.raw_logs(spark, SF)), ("labels", derived.labels(spark, SF))):
        table.write.option("header", True).option("escape", '"').csv(str(tmp_path / name))
    logs = readers.join_labels(
        readers.load_access_logs(spark, str(tmp_path / "logs")), readers.read_labels(spark, str(tmp_path / "labels"))
    )
    features = written(features_of(logs))
    assert features.count() == logs.count()
    flagged = features.where(scoring.is_flagged()).withColumn("target_class", rules.target_class(F.col("label")))
    model = models.classifier_fit(flagged, chain.FEATURES, trees=5)
    alerts = models.predict(flagged, model)
    cards = written(attribution.explain_cards(alerts, logs, models.importances(model, chain.FEATURES)))
    assert cards.count() == flagged.count() > 0
    one = cards.first()["event_id"]
    assert attribution.explain_event(cards, one).first()["event_id"] == one
    with pytest.raises(ValueError, match="no event"):
        attribution.explain_event(cards, "nobody")
    queue = triage.alert_queue(alerts.withColumn("risk_score", F.col("score_ensemble")))
    assert queue.first()["event_id"] in {c["event_id"] for c in cards.collect()}


def test_scans_of_the_log_follow_its_rows(spark, monkeypatch):
    """The log in one file or in few is read by as many tasks as its rows ask for, not by as many as its packed bytes do."""
    monkeypatch.setattr(session, "ROWS_A_SCAN", 50)
    log = derived.access_log(spark, SF).coalesce(1)
    learned = chain.learn(log)
    rows = log.count()
    with session.held(spark, session.sized_tasks(spark, rows)):
        read = [r["count"] for r in learned.events.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(read) == rows > 500 and max(read) <= 100
