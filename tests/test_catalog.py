"""Registered queries against their check SQL on the smallest tables.

All of them; LOGVIGIL_FEW=1 runs only those that cover a step of the chain each.
"""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from logvigil.functions import rules
from logvigil.plans import derived, registry
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
FEW = (
    "src_logs", "snk_predictions_check", "baseline_features", "stat_profile_score", "sequence_surprise", "combined_features", "rolling_minmax",
    "chrono_split", "hour_density", "vocab_encode", "model_comparison", "classification_report_check", "explain_card_check", "feature_narrative",
    "dq_audit", "detect_insider_drift", "best_base_scores", "stream_failed_auth", "rule_queue", "stratified_folds", "sample_replace",
)
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", FEW if os.environ.get("LOGVIGIL_FEW") else sorted(registry.CHECKS))
def test_query_equals_sql(spark, con, name):
    got = spark_entry.queries()[name](spark, SF).toPandas()
    want = con.execute(spark_entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_every_check_has_a_query():
    assert set(registry.CHECKS) <= set(registry.QUERIES)
    unchecked = set(registry.QUERIES) - set(registry.CHECKS)
    by_model = {name.removesuffix("_check") for name in registry.CHECKS if name.endswith("_check")}
    assert by_model <= set(registry.QUERIES)
    assert unchecked == by_model | {
        "threat_classifier", "threat_classifier_boosted", "oof_predictions", "oof_report", "oof_confusion",
    }


def test_served_results_show_the_verdict(spark):
    """No placeholder stands where the classifier has spoken."""
    verdicts = {r["event_id"]: r["predicted_attack_type"] for r in spark_entry.queries()["alert_queue"](spark, SF).collect()}
    assert set(verdicts.values()) <= {c for c in (*rules.CLASSES, rules.UNKNOWN) if c != rules.NORMAL}
    report = {r["class"] for r in spark_entry.queries()["classification_report"](spark, SF).collect()}
    assert set(verdicts.values()) <= report and derived.MODEL_VERDICT not in report
    assert set(spark_entry.queries()["confusion_matrix"](spark, SF).columns).isdisjoint({derived.MODEL_VERDICT})
    first = {r["feature"] for r in spark_entry.queries()["importance_attribution"](spark, SF).where("rank = 1").collect()}
    given = {r["feature"] for r in spark_entry.queries()["importance_attribution_check"](spark, SF).where("rank = 1").collect()}
    assert first and first != given
    card = spark_entry.queries()["explain_card"](spark, SF).first()
    assert card["attack_type"] == verdicts[card["event_id"]] and card["reasons"].count(": ") >= 3


def test_entry(spark):
    rows = spark_entry.entry(spark)
    assert rows.columns[0] == "event_id" and rows.count() > 0
