"""Profiles, fitted constants, metrics and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from logvigil.functions import rules
from logvigil.operators import metrics, profiles, scoring, sequence, triage
from logvigil.plans import derived, verdicts
from logvigil.plans.catalog_columns import TARGET, VOCAB, located
from logvigil.plans.catalog_sources import PROFILE_SQL, flat_profile
from logvigil.plans.oracle import r4
from logvigil.plans.registry import query


def normal(spark, sf):
    return profiles.normal_training(derived.learned(spark, sf).events)


def judged(spark, sf, split: str):
    """Scores of one part with the binary label ``y``."""
    return derived.scored(spark, sf).where(F.col("split") == split).withColumn("y", rules.binary_label(F.col("label")))


def predictions(spark, sf):
    """Class and out-of-fold prediction of each alert."""
    return derived.alerts(spark, sf).select(
        "event_id", F.col("target_class").alias("actual"), F.col("predicted_attack_type").alias("predicted")
    )


def checkable_predictions(spark, sf):
    """The same with one mark for all that the classifier said."""
    rows = derived.alerts(spark, sf).select("event_id", "target_class", "predicted_attack_type")
    rows = derived.checkable(rows, derived.alerts(spark, sf))
    return rows.select("event_id", F.col("target_class").alias("actual"), F.col("predicted_attack_type").alias("predicted"))


@query("entity_profile", PROFILE_SQL)
def entity_profile(spark, sf):
    return flat_profile(profiles.entity_profile(normal(spark, sf), derived.learned(spark, sf).hot))


@query("global_profile", f"""SELECT num_events, {r4('home_lat', 'home_lon', '1000.0e0 AS avg_radius', 'duration_mean', 'duration_std')},
  (SELECT max(ts_us) FROM tn) AS last_ts_us,
  (SELECT string_agg(resource_accessed, ',' ORDER BY n DESC, resource_accessed) FROM gr) AS resources,
  (SELECT string_agg(concat(md, ':', n), ',' ORDER BY md) FROM eh WHERE owner = '') AS minutes FROM gp""")
def global_profile(spark, sf):
    return flat_profile(profiles.global_profile(normal(spark, sf)))


@query("topk_per_group", "SELECT entity_id, resource_accessed, n, cast(rank AS integer) AS rank FROM tr")
def topk_per_group(spark, sf):
    return profiles.top_resources(normal(spark, sf), profiles.ENTITY_RESOURCES)


@query("distinct_set", "SELECT entity_id AS owner, mac FROM ed UNION ALL SELECT '' AS owner, mac FROM gd")
def distinct_set(spark, sf):
    return profiles.owned(normal(spark, sf), "mac").select("owner", "mac")


@query("hour_density", f"SELECT owner, md AS minute, {r4('density')} FROM dn")
def hour_density(spark, sf):
    learned = derived.learned(spark, sf)
    return profiles.hour_density(profiles.owner_minutes(learned.events, learned.profiles), learned.profiles, learned.everybody)


@query("centroid_fit", f"SELECT entity_id, {r4('c_lat', 'c_lon')} FROM ce")
def centroid_fit(spark, sf):
    return sequence.centroid_fit(derived.learned(spark, sf).events.where(F.col("split") == "train"))


@query("scaling_fit", f"SELECT {r4('mean_dur', 'std_dur', 'mean_dist', 'std_dist')} FROM sc")
def scaling_fit(spark, sf):
    return sequence.scaling_fit(located(spark, sf).where(F.col("split") == "train"))


@query("vocab_fit", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, value, idx FROM {VOCAB.format(c=c)}" for c in ("resource_accessed", "auth_method", "os")))
def vocab_fit(spark, sf):
    train = derived.learned(spark, sf).events.where(F.col("split") == "train")
    out = None
    for c in ("resource_accessed", "auth_method", "os"):
        part = sequence.vocab_fit(train, c).select(F.lit(c).alias("feature"), "value", "idx")
        out = part if out is None else out.unionByName(part)
    return out


@query("class_distribution", f"""SELECT label, count(*) AS n, {r4('count(*) * 100.0e0 / sum(count(*)) OVER () AS pct',
  "sum(CASE WHEN label <> 'normal' THEN count(*) ELSE 0 END) OVER () * 100.0e0 / sum(count(*)) OVER () AS anomaly_rate")}
  FROM al GROUP BY label""")
def class_distribution(spark, sf):
    return metrics.class_distribution(derived.labels(spark, sf))


@query("numeric_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + r4(f"cast(min({c}) AS double) AS min", f"cast(max({c}) AS double) AS max", f"avg({c}) AS mean",
                                     f"stddev_samp({c}) AS std", f"quantile_cont({c}, 0.5) AS median") + " FROM al"
    for c in ("session_duration", "bytes_transferred")))
def numeric_summary(spark, sf):
    return metrics.numeric_summary(derived.access_log(spark, sf), ["session_duration", "bytes_transferred"])


@query("percentile_threshold", f"""SELECT 'all' AS scope, {r4('quantile_cont(score, 0.99) AS threshold')} FROM bs
  UNION ALL SELECT 'benign validation', {r4('threshold')} FROM th
  UNION ALL SELECT 'alert share', {r4('quantile_cont(score_ensemble, 0.95) AS threshold')} FROM e1 WHERE split = 'val'""")
def percentile_threshold(spark, sf):
    rows = derived.scored(spark, sf)
    val = rows.where(F.col("split") == "val")
    values = [
        ("all", scoring.exact_percentile(rows, "score", scoring.ALERT_QUANTILE)[0]),
        ("benign validation", scoring.calibrated_threshold(rows)),
        ("alert share", scoring.exact_percentile(val, "score_ensemble", scoring.FALLBACK_QUANTILE)[0]),
    ]
    return spark.createDataFrame(values, "scope string, threshold double")


@query("score_minmax", f"SELECT {r4('sl AS low', 'sh AS high')} FROM er2")
def score_minmax(spark, sf):
    val = derived.scored(spark, sf).where(F.col("split") == "val")
    return val.agg(F.min("seq_error").alias("low"), F.max("seq_error").alias("high"))


CURVE = """(SELECT score, sum(y) AS tp, sum(1 - y) AS fp, sum(sum(y)) OVER w AS ctp, sum(sum(1 - y)) OVER w AS cfp
  FROM (SELECT {score} AS score, CASE WHEN label <> 'normal' THEN 1 ELSE 0 END AS y FROM e1 WHERE split = '{split}')
  GROUP BY score WINDOW w AS (ORDER BY score DESC))"""
ROC = "sum(fp * (ctp - tp / 2.0e0)) / (sum(tp) * sum(fp))"
PR = """sum(tp * (ctp / (ctp + cfp) + CASE WHEN ctp - tp + cfp - fp = 0 THEN 1.0e0
  ELSE (ctp - tp) / (ctp - tp + cfp - fp) END) / 2.0e0) / sum(tp)"""
TOP = """(SELECT CASE WHEN score >= t THEN 1 ELSE 0 END AS hit, y, t FROM
  (SELECT {score} AS score, CASE WHEN label <> 'normal' THEN 1 ELSE 0 END AS y, quantile_cont({score}, 0.99) OVER () AS t
   FROM e1 WHERE split = '{split}'))"""


@query("roc_auc", f"SELECT {r4(ROC + ' AS roc_auc')} FROM {CURVE.format(score='score', split='test')}")
def roc_auc(spark, sf):
    return metrics.score_curve(judged(spark, sf, "test")).agg(metrics.roc_auc_of().alias("roc_auc"))


@query("pr_auc", f"SELECT {r4(PR + ' AS pr_auc')} FROM {CURVE.format(score='score', split='test')}")
def pr_auc(spark, sf):
    return metrics.score_curve(judged(spark, sf, "test")).agg(metrics.pr_auc_of().alias("pr_auc"))


@query("fpr_at_top1", f"""SELECT {r4('sum(CASE WHEN hit = 1 AND y = 0 THEN 1 ELSE 0 END) * 1.0e0 / sum(1 - y) AS fpr_at_1',
  'any_value(t) AS threshold')} FROM {TOP.format(score='score', split='val')}""")
def fpr_at_top1(spark, sf):
    return metrics.fpr_at_top1(judged(spark, sf, "val"))


@query("precision_at_top1", f"""SELECT {r4('sum(CASE WHEN hit = 1 THEN y ELSE 0 END) * 1.0e0 / sum(hit) AS precision_at_1',
  'any_value(t) AS threshold')} FROM {TOP.format(score='score_ensemble', split='test')}""")
def precision_at_top1(spark, sf):
    return metrics.precision_at_top1(judged(spark, sf, "test"), "score_ensemble")


MODELS = {"profile": "score", "sequence": "score_seq", "ensemble": "score_ensemble"}


TOP_RATES = r4(
    "sum(CASE WHEN hit = 1 AND y = 0 THEN 1 ELSE 0 END) * 1.0e0 / sum(1 - y) AS fpr_at_1",
    "sum(CASE WHEN hit = 1 THEN y ELSE 0 END) * 1.0e0 / sum(hit) AS precision_at_1",
)


def comparison_sql(scores: dict[str, str], table: str = "e1") -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{m}' AS model, c.*, f.* FROM (SELECT {r4(ROC + ' AS roc_auc', PR + ' AS pr_auc')} FROM {CURVE.format(score=s, split='val')}) c,"
        f" (SELECT {TOP_RATES} FROM {TOP.format(score=s, split='val')}) f"
        for m, s in scores.items())
    parts = parts.replace("FROM e1 WHERE", f"FROM {table} WHERE")
    return f"SELECT *, CASE WHEN row_number() OVER (ORDER BY roc_auc DESC, model) = 1 THEN 1 ELSE 0 END AS best FROM ({parts})"


@query("model_comparison", comparison_sql(MODELS))
def model_comparison(spark, sf):
    return metrics.model_comparison(judged(spark, sf, "val"), MODELS)


PAIRS = f"(SELECT event_id, {TARGET.replace('target_class', 'actual')}, predicted_attack_type AS predicted FROM ra)"
REPORT = f"""(SELECT c AS class, coalesce(hit * 1.0e0 / nullif(named, 0), 0) AS precision, coalesce(hit * 1.0e0 / nullif(support, 0), 0) AS recall,
  support, hit FROM (SELECT c, sum(CASE WHEN actual = c THEN 1 ELSE 0 END) AS support, sum(CASE WHEN predicted = c THEN 1 ELSE 0 END) AS named,
  sum(CASE WHEN actual = c AND predicted = c THEN 1 ELSE 0 END) AS hit
  FROM {PAIRS} p JOIN (SELECT DISTINCT actual AS c FROM {PAIRS} UNION SELECT DISTINCT predicted FROM {PAIRS}) ON actual = c OR predicted = c GROUP BY c))"""
RATED = f"(SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM {REPORT})"


def masked_report(spark, sf):
    """Rules against labels; what the classifier decided counts as a class of its own."""
    return metrics.classification_report(checkable_predictions(spark, sf))


@verdicts.shown("classification_report", f"""SELECT class, {r4('precision', 'recall', 'f1')}, cast(support AS bigint) AS support FROM {RATED}
  UNION ALL SELECT 'accuracy', {r4('sum(hit) / sum(support) AS precision', 'sum(hit) / sum(support) AS recall',
                                   'sum(hit) / sum(support) AS f1')}, cast(sum(support) AS bigint) FROM {RATED}
  UNION ALL SELECT 'macro avg', {r4('avg(precision) AS precision', 'avg(recall) AS recall', 'avg(f1) AS f1')}, cast(sum(support) AS bigint) FROM {RATED}
  UNION ALL SELECT 'weighted avg', {r4('sum(precision * support) / sum(support) AS precision', 'sum(recall * support) / sum(support) AS recall',
                                       'sum(f1 * support) / sum(support) AS f1')}, cast(sum(support) AS bigint) FROM {RATED}""", masked_report)
def classification_report(spark, sf):
    """Precision, recall and F1 of rules and classifier together, out of fold."""
    return metrics.classification_report(predictions(spark, sf))


@query("oof_report")
def oof_report(spark, sf):
    """The out-of-fold report of rules and classifier together."""
    return metrics.classification_report(predictions(spark, sf))


SHOWN = [*[rules.UNKNOWN if c == rules.NORMAL else c for c in rules.CLASSES], derived.MODEL_VERDICT]


def masked_matrix(spark, sf):
    """All classes, and one column for what the classifier decided."""
    return metrics.confusion_matrix(checkable_predictions(spark, sf), SHOWN)


@verdicts.shown("confusion_matrix", "SELECT actual, " + ", ".join(
    f"cast(sum(CASE WHEN predicted = '{c}' THEN 1 ELSE 0 END) AS bigint) AS \"{c}\"" for c in SHOWN) + f" FROM {PAIRS} GROUP BY actual", masked_matrix)
def confusion_matrix(spark, sf):
    """Actual against predicted classes, rules and classifier together, out of fold."""
    return metrics.confusion_matrix(predictions(spark, sf), SHOWN[:-1])


@query("oof_confusion")
def oof_confusion(spark, sf):
    """The out-of-fold confusion matrix of rules and classifier together."""
    return metrics.confusion_matrix(predictions(spark, sf), SHOWN[:-1])


@query("balanced_weights", f"""SELECT event_id, actual, {r4('(SELECT count(*) FROM ra) * 1.0e0 / ((SELECT count(DISTINCT actual) FROM ' + PAIRS
  + ') * count(*) OVER (PARTITION BY actual)) AS weight')} FROM {PAIRS}""")
def balanced_weights(spark, sf):
    return metrics.balanced_weights(predictions(spark, sf).select("event_id", "actual"), "actual")


@query("kpi_counts", """SELECT count(*) FILTER (risk_score >= 0.8) AS critical,
  count(*) FILTER (risk_score >= 0.5 AND risk_score < 0.8) AS medium FROM ra""")
def kpi_counts(spark, sf):
    return triage.kpi_counts(derived.alerts(spark, sf))


@query("hour_histogram", "SELECT entity_id, cast(floor(hod) AS integer) AS hour, count(*) AS n FROM tn GROUP BY ALL")
def hour_histogram(spark, sf):
    return triage.hour_histogram(normal(spark, sf))


def masked_domains(spark, sf):
    return triage.filter_domains(derived.checkable(derived.alerts(spark, sf), derived.alerts(spark, sf)))


@verdicts.shown("filter_domains", """SELECT DISTINCT 'entity_type' AS domain, entity_type AS value FROM ra
  UNION ALL SELECT DISTINCT 'attack_type', predicted_attack_type FROM ra UNION ALL SELECT DISTINCT 'entity_id', entity_id FROM ra
  UNION ALL SELECT 'first_day', strftime(make_timestamp(min(ts_us)), '%Y-%m-%d') FROM ra
  UNION ALL SELECT 'last_day', strftime(make_timestamp(max(ts_us)), '%Y-%m-%d') FROM ra""", masked_domains)
def filter_domains(spark, sf):
    return triage.filter_domains(derived.alerts(spark, sf))


@query("entity_header", f"""SELECT l.entity_id, coalesce(num_events, seen) AS events, {r4('coalesce(home_lat, 0.0e0) AS home_lat',
  'coalesce(home_lon, 0.0e0) AS home_lon', 'coalesce(avg_radius, 10.0e0) AS avg_radius', 'decay')}
  FROM (SELECT entity_id, count(*) AS seen, arg_max(profile_decay_factor, (ts_us, event_id)) AS decay FROM bf GROUP BY entity_id) l
  LEFT JOIN pb USING (entity_id) LEFT JOIN pr USING (entity_id)""")
def entity_header(spark, sf):
    return triage.entity_header(derived.features(spark, sf), derived.learned(spark, sf).profiles)
