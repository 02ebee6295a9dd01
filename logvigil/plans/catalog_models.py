"""Models, attribution, cards and refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from logvigil.functions import rules
from logvigil.operators import attribution, chain, metrics, models, profiles, sequence
from logvigil.plans import derived, model_sql, verdicts
from logvigil.plans.catalog_aggregates import comparison_sql, normal
from logvigil.plans.catalog_columns import RULE_TEXT, TARGET, base
from logvigil.plans.catalog_sources import ISO, flat_profile
from logvigil.plans.oracle import hav, r4
from logvigil.plans.registry import query
from logvigil.session import written

# a given importance table, for the checks: falling with the place of the feature
IMPORTANCES = {f: round(1.0 / (i + 1), 4) for i, f in enumerate(chain.FEATURES)}


@query("baseline_features", "SELECT event_id, " + r4(
    "hour_of_day", "norm_session_duration", "geo_distance_from_centroid_km", "is_cold_start", "profile_decay_factor")
    + ", cast(day_of_week AS integer) AS day_of_week, " + ", ".join(
        f for f in profiles.BASE_FEATURES if f not in (
            "hour_of_day", "norm_session_duration", "geo_distance_from_centroid_km", "is_cold_start", "profile_decay_factor", "day_of_week"))
    + " FROM bf")
def baseline_features(spark, sf):
    return base(spark, sf).select("event_id", *profiles.BASE_FEATURES)


@query("stat_profile_score", f"SELECT event_id, entity_id, {r4('score', 'density')} FROM bs")
def stat_profile_score(spark, sf):
    return chain.base_scores(derived.learned(spark, sf)).select("event_id", "entity_id", "score", "density")


@query("isolation_forest", f"SELECT event_id, label, {r4('iforest_score')} FROM {model_sql.FOREST}")
def isolation_forest(spark, sf):
    rows = derived.features(spark, sf)
    train = rows.where((F.col("split") == "train") & (F.col("label") == "normal"))
    forest = models.isolation_forest_fit(train, profiles.BASE_FEATURES)
    return models.isolation_forest_score(rows, forest, profiles.BASE_FEATURES).select("event_id", "label", "iforest_score")


@query("one_class_rbf", f"SELECT event_id, label, {r4('one_class_score')} FROM {model_sql.ONE_CLASS}")
def one_class_rbf(spark, sf):
    rows = derived.features(spark, sf)
    train = rows.where((F.col("split") == "train") & (F.col("label") == "normal"))
    model = models.one_class_fit(train, profiles.BASE_FEATURES)
    return models.one_class_score(rows, model).select("event_id", "label", "one_class_score")


CANDIDATES = f"""cand AS MATERIALIZED (SELECT event_id, label, split, score, round(iforest_score, {models.SCORE_DIGITS}) AS iforest_score,
  round(one_class_score, {models.SCORE_DIGITS}) AS one_class_score FROM (SELECT event_id, label, split, score FROM bs)
  JOIN (SELECT event_id, iforest_score FROM {model_sql.FOREST}) USING (event_id)
  JOIN (SELECT event_id, one_class_score FROM {model_sql.ONE_CLASS}) USING (event_id))"""
COMPARED = comparison_sql(chain.BASE_MODELS, "cand")


def judged_columns(rows):
    """What the base models read, and what they are judged by: no other column is written again with their scores."""
    return rows.select("event_id", "label", "split", "score", *profiles.BASE_FEATURES)


@query("baseline_selection", f"SELECT * FROM (WITH {CANDIDATES} {COMPARED})")
def baseline_selection(spark, sf):
    """Validation metrics of the three base models; the best by ROC area is marked."""
    rows = written(models.baseline_candidates(judged_columns(derived.features(spark, sf)), profiles.BASE_FEATURES))
    val = rows.where(F.col("split") == "val").withColumn("y", rules.binary_label(F.col("label")))
    return metrics.model_comparison(val, chain.BASE_MODELS)


@query("best_base_scores", f"""SELECT event_id, model, {r4('score')} FROM (WITH {CANDIDATES}, best AS (SELECT model FROM ({COMPARED}) WHERE best = 1)
  SELECT event_id, model, CASE model WHEN 'isolation_forest' THEN iforest_score WHEN 'one_class' THEN one_class_score ELSE score END AS score
  FROM cand CROSS JOIN best)""")
def best_base_scores(spark, sf):
    """All events scored with the base model that wins on the validation part."""
    rows, model = chain.best_base_scores(judged_columns(derived.scored(spark, sf)))
    return rows.select("event_id", F.lit(model).alias("model"), "score")


@query("sequence_surprise", f"SELECT event_id, {r4(*sequence.ERROR_COLUMNS, 'seq_error')} FROM et")
def sequence_surprise(spark, sf):
    learned = derived.learned(spark, sf)
    rows = chain.sequence_errors(learned.events, learned.hot)
    return rows.select("event_id", *sequence.ERROR_COLUMNS, "seq_error")


@query("combined_features", "SELECT event_id, " + r4(*[f"cast({f} AS double) AS {f}" for f in chain.FEATURES]) + " FROM cf")
def combined_features(spark, sf):
    learned = derived.learned(spark, sf)
    rows = chain.combined_features(learned, derived.scored(spark, sf))
    return rows.select("event_id", *[F.col(f).cast("double").alias(f) for f in chain.FEATURES])


PREDICTED = ("event_id", "target_class", "predicted_attack_type", "confidence", "prediction_source")


@query("threat_classifier")
def threat_classifier(spark, sf):
    rows = derived.flagged(spark, sf)
    model = models.classifier_fit(rows, chain.FEATURES)
    return models.predict(rows, model).select(*PREDICTED)


@query("threat_classifier_boosted")
def threat_classifier_boosted(spark, sf):
    """The same with boosted trees, one model a class."""
    rows = derived.flagged(spark, sf)
    model = models.classifier_fit(rows, chain.FEATURES, boosted=True)
    return models.predict(rows, model).select(*PREDICTED)


CHECKED_PREDICTION = f"""SELECT event_id, {TARGET}, coalesce(rule, '(model)') AS predicted_attack_type,
  coalesce({RULE_TEXT}, 'Spark ML Classifier') AS prediction_source"""


@verdicts.shown("cv_oof", f"""{CHECKED_PREDICTION}, cast((row_number() OVER (PARTITION BY CASE WHEN label = 'normal' THEN 'unknown' ELSE label END
  ORDER BY md5(concat('42::', cast(event_id AS varchar))), event_id) - 1) % 5 AS integer) AS fold FROM ra""")
def cv_oof(spark, sf):
    """Fold and out-of-fold prediction of each alert: the rule's class where one fired, else the classifier's."""
    return derived.alerts(spark, sf).select("event_id", "target_class", "predicted_attack_type", "prediction_source", "fold")


@query("oof_predictions")
def oof_predictions(spark, sf):
    """The out-of-fold predictions as they are."""
    return derived.alerts(spark, sf).select(*PREDICTED, "fold")


def event_predictions(spark, sf):
    """The model fitted on the flagged events, applied to every event, with the features that speak for it."""
    model = models.classifier_fit(derived.flagged(spark, sf), chain.FEATURES)
    rows = derived.features(spark, sf).withColumn("target_class", rules.target_class(F.col("label")))
    return models.predict(rows, model, models.importances(model, chain.FEATURES))


def masked_events(spark, sf):
    """The same with one mark for what the classifier said, and for its features if they are three of the model's."""
    rows = written(event_predictions(spark, sf))
    names = F.array(*[F.lit(c) for c in chain.FEATURES])
    three = (F.size("top_features") == 3) & (F.size(F.array_intersect(F.col("top_features.feature"), names)) == 3)
    by_model = F.col("prediction_source") == rules.MODEL_TEXT
    told = F.when(~by_model, features_text()).when(three, F.lit(derived.MODEL_VERDICT)).otherwise(F.lit(derived.WRONG_VERDICT))
    shown = rows.select("event_id", "target_class", "predicted_attack_type", "prediction_source", told.alias("top_features"))
    return derived.checkable(shown, rows)


@verdicts.shown("predict_event", f"""{CHECKED_PREDICTION}, CASE WHEN rule IS NULL THEN '(model)' ELSE concat(CASE WHEN rule = 'impossible_travel'
  THEN 'geo_velocity_kmh' ELSE 'failed_auth_count_5min' END, '=1.0,rule_override_trigger=1.0') END AS top_features FROM rl""", masked_events)
def predict_event(spark, sf):
    """Type, confidence and features behind it for every event."""
    return event_predictions(spark, sf).select(*PREDICTED, features_text().alias("top_features"))


def features_text():
    return F.array_join(F.transform("top_features", lambda f: F.concat_ws("=", f["feature"], f["weight"].cast("string"))), ",")


def _weights(sequence_part: bool) -> str:
    parts = []
    for place, (f, w) in enumerate(IMPORTANCES.items()):
        weight = f"abs(cast({f} AS double)) * {w}e0"
        if sequence_part:
            error = attribution.ERROR_OF_FEATURE.get(f, "0.0e0")
            weight = f"0.6e0 * ({weight}) + 0.4e0 * {error}"
        parts.append(f"SELECT event_id, {place} AS place, '{f}' AS feature, cast({f} AS double) AS value, {weight} AS weight FROM ra")
    return "(" + " UNION ALL ".join(parts) + ")"


def model_importances(spark, sf):
    """Importances of the classifier fitted on all flagged events, by feature."""

    def fitted():
        return models.importances(models.classifier_fit(derived.flagged(spark, sf), chain.FEATURES), chain.FEATURES)

    return derived.shared(spark, sf, "importances", fitted)


def by_importance(spark, sf, weights):
    return attribution.importance_attribution(derived.alerts(spark, sf), weights)


def by_both(spark, sf, weights):
    return attribution.combined_attribution(derived.alerts(spark, sf), weights)


def three_reasons(spark, sf, weights):
    rows = attribution.with_reasons(derived.alerts(spark, sf), weights)
    rows = rows.select("event_id", F.posexplode("reasons").alias("rank", "r"))
    return rows.select("event_id", (F.col("rank") + 1).alias("rank"), "r.feature", "r.value")


def with_given(attributed):
    """The same with the given importances, which SQL knows."""
    return lambda spark, sf: attributed(spark, sf, IMPORTANCES)


@verdicts.shown("importance_attribution", f"""SELECT event_id, cast(rank AS integer) AS rank, feature, {r4('value', 'weight')} FROM (SELECT *, row_number() OVER
  (PARTITION BY event_id ORDER BY weight DESC, place) AS rank FROM {_weights(False)}) WHERE rank <= 3""", with_given(by_importance))
def importance_attribution(spark, sf):
    """The three features of each alert with the largest value times importance in the fitted model."""
    return by_importance(spark, sf, model_importances(spark, sf))


@verdicts.shown("combined_attribution", f"SELECT event_id, feature, {r4('value', 'weight')} FROM {_weights(True)}", with_given(by_both))
def combined_attribution(spark, sf):
    """Model weights and sequence errors of each feature together."""
    return by_both(spark, sf, model_importances(spark, sf))


REASONS_SQL = f"""(SELECT event_id, feature, value, row_number() OVER
  (PARTITION BY event_id ORDER BY forced, weight DESC, place) AS rank FROM (SELECT w.*, CASE
    WHEN rule = 'impossible_travel' AND feature = 'geo_velocity_kmh' THEN 0 WHEN rule = 'impossible_travel' AND feature = 'geo_distance_prev_km' THEN 1
    WHEN rule = 'brute_force' AND feature = 'failed_auth_count_5min' THEN 0 ELSE 2 END AS forced
    FROM {_weights(True)} w JOIN (SELECT event_id, rule FROM ra) USING (event_id)))"""


@verdicts.shown("top3_reasons", f"SELECT event_id, cast(rank AS integer) AS rank, feature, {r4('value')} FROM {REASONS_SQL} WHERE rank <= 3", with_given(three_reasons))
def top3_reasons(spark, sf):
    """Trigger of the rule first, then features by both weights."""
    return three_reasons(spark, sf, model_importances(spark, sf))


def alert_cards(spark, sf):
    return attribution.explain_cards(derived.alerts(spark, sf), derived.access_log(spark, sf), model_importances(spark, sf))


def history_text():
    return F.array_join(F.transform("entity_history_snippet", lambda h: F.concat_ws("|", h["event_id"], h["timestamp"], h["resource_accessed"])), ";")


def masked_cards(spark, sf):
    """Reasons that rest on the model are counted, those of a rule shown."""
    alerts = derived.alerts(spark, sf)
    own = F.when(F.col("attack_type") == "impossible_travel", 2).when(F.col("attack_type") == "brute_force", 1).otherwise(0)
    by_rule = F.when(F.col("rule_shown"), F.array_join(F.slice(F.col("reasons.feature"), 1, own), ",")).otherwise(F.lit(""))
    told = F.size(F.filter("reasons", lambda r: F.length(r["narrative"]) > 0))
    sources = alerts.select("event_id", (F.col("prediction_source") != rules.MODEL_TEXT).alias("rule_shown"))
    shown = alert_cards(spark, sf).join(sources, "event_id").select(
        "event_id", "risk_score", "attack_type", "cold_start", by_rule.alias("rule_reasons"), told.alias("n_reasons"), history_text().alias("history")
    )
    return derived.checkable(shown, alerts, "attack_type")


@verdicts.shown("explain_card", f"""SELECT event_id, {r4('round(score_ensemble, 4) AS risk_score')}, predicted_attack_type AS attack_type, cold AS cold_start,
  CASE WHEN rule = 'impossible_travel' THEN 'geo_velocity_kmh,geo_distance_prev_km' WHEN rule = 'brute_force' THEN 'failed_auth_count_5min' ELSE '' END
  AS rule_reasons, 3 AS n_reasons, history FROM ra
  JOIN (SELECT event_id, array_to_string(list(concat_ws('|', event_id, {ISO}, resource_accessed)) OVER (PARTITION BY entity_id
    ORDER BY ts_us, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ';') AS history FROM al) USING (event_id)""", masked_cards)
def explain_card(spark, sf):
    """The card of each alert: reasons by the importances of the model, in sentences, and the entity's last events."""
    reasons = F.transform("reasons", lambda r: F.concat_ws(": ", r["feature"], r["narrative"]))
    return alert_cards(spark, sf).select(
        "event_id", "risk_score", "attack_type", "cold_start", F.array_join(reasons, "; ").alias("reasons"), history_text().alias("history")
    )


SEEN = "(SELECT * FROM sp WHERE label = 'normal' AND split IN ('train', 'val'))"
REFIT = f"""(SELECT entity_id, count(*) AS num_events, avg(lat) AS home_lat, avg(lon) AS home_lon, avg(session_duration) AS duration_mean,
  CASE WHEN count(*) > 1 THEN stddev_pop(session_duration) ELSE 10.0e0 END AS duration_std, stddev_samp(hod) AS hour_std, var_pop(hod) AS hour_var,
  max(ts_us) AS last_ts_us FROM {SEEN} GROUP BY entity_id)"""


def refreshed_parts(spark, sf):
    """Parts learned on the training part, and written, merged with those of the validation part."""
    new = derived.learned(spark, sf).events.where((F.col("label") == "normal") & (F.col("split") == "val"))
    old = {name: written(part) for name, part in profiles.profile_parts(normal(spark, sf)).items()}
    return profiles.merge_parts(old, profiles.profile_parts(new))


@query("incremental_refit", f"""SELECT entity_id, num_events, {r4('home_lat', 'home_lon', 'duration_mean', 'duration_std', 'hour_std', 'hour_var')},
  last_ts_us FROM {REFIT}""")
def incremental_refit(spark, sf):
    """Moments learned on the training part, refreshed with the validation part."""
    return profiles.profile_from_moments(refreshed_parts(spark, sf)["moments"])


@query("incremental_profile", f"""SELECT entity_id, num_events, {r4('home_lat', 'home_lon', 'avg_radius', 'duration_mean', 'duration_std', 'hour_std', 'hour_var')},
  last_ts_us, resources, minutes FROM {REFIT}
  JOIN (SELECT entity_id, avg({hav('home_lat', 'home_lon', 'lat', 'lon')}) AS avg_radius FROM {SEEN} JOIN {REFIT} USING (entity_id) GROUP BY entity_id)
    USING (entity_id)
  JOIN (SELECT entity_id, string_agg(resource_accessed, ',' ORDER BY n DESC, resource_accessed) AS resources FROM (SELECT *, row_number() OVER
    (PARTITION BY entity_id ORDER BY n DESC, resource_accessed) AS rank FROM (SELECT entity_id, resource_accessed, count(*) AS n FROM {SEEN}
    GROUP BY ALL)) WHERE rank <= 5 GROUP BY entity_id) USING (entity_id)
  JOIN (SELECT entity_id, string_agg(concat(md, ':', n), ',' ORDER BY md) AS minutes FROM (SELECT entity_id, md, count(*) AS n FROM {SEEN}
    GROUP BY ALL) GROUP BY entity_id) USING (entity_id)""")
def incremental_profile(spark, sf):
    """Whole profiles learned on the training part, refreshed with the validation part: every column that scoring reads."""
    return flat_profile(profiles.profile_from_parts(refreshed_parts(spark, sf)), hours=True)


@query("incremental_devices", f"SELECT entity_id, mac FROM {SEEN} WHERE mac <> '' GROUP BY ALL")
def incremental_devices(spark, sf):
    """The devices that belong to the refreshed profiles."""
    return refreshed_parts(spark, sf)["devices"]


@query("incremental_transitions", """SELECT feature, prev, cur, cast(sum(c) AS bigint) AS c FROM (""" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, prev_{n} AS prev, cur_{n} AS cur, count(*) AS c FROM sx WHERE split <> 'test' GROUP BY ALL"
    for n in sequence.CATEGORICAL) + ") GROUP BY feature, prev, cur")
def incremental_transitions(spark, sf):
    """Transition counts of the training part, refreshed with the validation part."""
    rows = sequence.with_last_values(derived.learned(spark, sf).events)
    old = written(sequence.transition_counts(rows.where(F.col("split") == "train")))
    new = sequence.transition_counts(rows.where(F.col("split") == "val"))
    return profiles.merge_sums(old, new, ["feature", "prev", "cur"])
