"""Projections, scalar expressions, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from logvigil.functions import clock, rules, scores
from logvigil.functions.geo import haversine_km
from logvigil.operators import chain, profiles, scoring, sequence, triage
from logvigil.plans import derived, verdicts
from logvigil.plans.catalog_sources import ISO
from logvigil.plans.oracle import hav, r4
from logvigil.plans.registry import query
from logvigil.sources import readers, stores

TARGET = "CASE WHEN label = 'normal' THEN 'unknown' ELSE label END AS target_class"


def base(spark, sf):
    """Base features of all events (the features table holds the same columns)."""
    learned = derived.learned(spark, sf)
    return profiles.base_features(learned.events, learned.profiles, learned.devices, learned.everybody, learned.hot)


@query("parse_json_fields", f"""SELECT event_id, {r4("CASE WHEN event_id % 7 < 2 THEN 0.0e0 ELSE lat END AS lat", "CASE WHEN event_id % 7 < 2 THEN 0.0e0 ELSE lon END AS lon")},
  CASE WHEN event_id % 7 < 2 THEN '' ELSE mac END AS mac, CASE WHEN event_id % 7 < 2 THEN '' ELSE os END AS os FROM al""")
def parse_json_fields(spark, sf):
    logs = derived.raw_logs(spark, sf).withColumn("event_id", F.col("event_id").cast("long"))

    def damage(c):
        """Every seventh text is missing, every seventh broken."""
        return F.when(F.col("event_id") % 7 == 0, F.lit(None)).when(F.col("event_id") % 7 == 1, F.lit("x")).otherwise(F.col(c))

    logs = logs.withColumns({c: damage(c) for c in ("geo_location", "device_fingerprint")})
    return readers.parse_json_fields(logs).select("event_id", "lat", "lon", "mac", "os")


@query("parse_ts", f"""SELECT cast(event_id AS varchar) AS event_id, ts_us, {ISO} AS iso,
  strftime(make_timestamp(ts_us), '%Y-%m-%d %H:%M:%S') AS naive FROM al""")
def parse_ts(spark, sf):
    parsed = derived.raw_logs(spark, sf).select("event_id", clock.parse_iso(F.col("timestamp")).alias("ts_us"))
    naive = F.date_format(clock.wall_clock(F.col("ts_us")), "yyyy-MM-dd HH:mm:ss")
    return parsed.select("event_id", "ts_us", clock.iso_text(F.col("ts_us")).alias("iso"), naive.alias("naive"))


@query("time_parts", f"""SELECT event_id, {r4('hod AS hour_of_day')}, cast(isodow(make_timestamp(ts_us)) - 1 AS integer) AS day_of_week,
  CASE WHEN isodow(make_timestamp(ts_us)) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM al""")
def time_parts(spark, sf):
    ts = F.col("ts_us")
    return derived.access_log(spark, sf).select(
        "event_id", clock.hour_of_day(ts).alias("hour_of_day"), clock.day_of_week(ts).cast("int").alias("day_of_week"),
        clock.is_weekend(ts).alias("is_weekend"),
    )


@query("hour_cyclic", f"""SELECT event_id, {r4('sin(2 * pi() * h / 24) AS hour_sin', 'cos(2 * pi() * h / 24) AS hour_cos')} FROM (
  SELECT event_id, (sec % 86400) // 3600 + ((sec % 3600) // 60) / 60.0e0 + (sec % 60) / 3600.0e0 AS h FROM al)""")
def hour_cyclic(spark, sf):
    ts = F.col("ts_us")
    return derived.access_log(spark, sf).select(
        "event_id", clock.hour_sin(ts).alias("hour_sin"), clock.hour_cos(ts).alias("hour_cos")
    )


@query("haversine_km", f"SELECT event_id, {r4(hav('40.7128e0', '-74.006e0', 'lat', 'lon') + ' AS km')} FROM al")
def haversine(spark, sf):
    km = haversine_km(F.lit(40.7128), F.lit(-74.006), F.col("lat"), F.col("lon"))
    return derived.access_log(spark, sf).select("event_id", km.alias("km"))


@query("geo_from_centroid", f"SELECT event_id, {r4('geo_distance_from_centroid_km')} FROM bf")
def geo_from_centroid(spark, sf):
    return base(spark, sf).select("event_id", "geo_distance_from_centroid_km")


AUTH = ("auth_password", "auth_token", "auth_certificate", "auth_biometric")


@query("auth_onehot", "SELECT event_id, " + ", ".join(
    f"CASE WHEN auth_method = '{a.removeprefix('auth_')}' THEN 1 ELSE 0 END AS {a}" for a in AUTH) + " FROM al")
def auth_onehot(spark, sf):
    flags = [rules.auth_flag(F.col("auth_method"), a.removeprefix("auth_")).alias(a) for a in AUTH]
    return derived.access_log(spark, sf).select("event_id", *flags)


@query("norm_session_duration", f"SELECT event_id, {r4('norm_session_duration')} FROM bf")
def norm_session_duration(spark, sf):
    return base(spark, sf).select("event_id", "norm_session_duration")


@query("resource_novelty", "SELECT event_id, resource_novelty FROM bf")
def resource_novelty(spark, sf):
    return base(spark, sf).select("event_id", "resource_novelty")


@query("device_novelty", "SELECT event_id, device_fingerprint_hash_novelty AS device_novelty FROM bf")
def device_novelty(spark, sf):
    return base(spark, sf).select("event_id", F.col("device_fingerprint_hash_novelty").alias("device_novelty"))


@query("profile_decay", f"SELECT event_id, {r4('profile_decay_factor')} FROM bf")
def profile_decay(spark, sf):
    return base(spark, sf).select("event_id", "profile_decay_factor")


@query("score_geo", f"SELECT event_id, {r4('least(1.0e0, geo_distance_from_centroid_km / 150) AS score_geo')} FROM bf")
def score_geo(spark, sf):
    return base(spark, sf).select("event_id", scores.score_geo(F.col("geo_distance_from_centroid_km")).alias("score_geo"))


@query("score_duration", f"SELECT event_id, {r4('1 - exp(-abs(norm_session_duration) / 2) AS score_duration')} FROM bf")
def score_duration(spark, sf):
    return base(spark, sf).select("event_id", scores.score_duration(F.col("norm_session_duration")).alias("score_duration"))


@query("score_time", f"""SELECT event_id, {r4('CASE WHEN density IS NULL THEN 0.5e0 ELSE greatest(0.0e0, least(1.0e0, 1 - density / 0.25e0)) END AS score_time')} FROM bs""")
def score_time(spark, sf):
    rows = chain.base_scores(derived.learned(spark, sf))
    return rows.select("event_id", scores.score_time(F.col("density")).alias("score_time"))


@query("stat_score", f"SELECT event_id, {r4('score')} FROM bs")
def stat_score(spark, sf):
    return chain.base_scores(derived.learned(spark, sf)).select("event_id", "score")


def located(spark, sf):
    """All events with the distance to their training centroid."""
    learned = derived.learned(spark, sf)
    train = learned.events.where(F.col("split") == "train")
    return sequence.centroid_lookup(learned.events, sequence.centroid_fit(train), sequence.global_centroid(train), learned.hot)


@query("scale_sequence_features", f"SELECT event_id, {r4('x_duration', 'x_hour_sin', 'x_hour_cos', 'x_geo_dist')} FROM sx")
def scale_sequence_features(spark, sf):
    rows = located(spark, sf)
    scaling = sequence.scaling_fit(rows.where(F.col("split") == "train")).first()
    return sequence.scale_features(rows, scaling).select("event_id", "x_duration", "x_hour_sin", "x_hour_cos", "x_geo_dist")


VOCAB = """(SELECT value, 1 + row_number() OVER (ORDER BY first_us, value) AS idx FROM
  (SELECT {c} AS value, min(ts_us) AS first_us FROM sp WHERE split = 'train' GROUP BY {c}))"""


@query("vocab_encode", f"""SELECT event_id, coalesce(r.idx, 1) AS res_idx, coalesce(o.idx, 1) AS os_idx FROM al
  LEFT JOIN {VOCAB.format(c='resource_accessed')} r ON r.value = resource_accessed
  LEFT JOIN {VOCAB.format(c='os')} o ON o.value = os""")
def vocab_encode(spark, sf):
    split = derived.learned(spark, sf).events
    train = split.where(F.col("split") == "train")
    rows = sequence.vocab_encode(split, "resource_accessed", sequence.vocab_fit(train, "resource_accessed"), "res_idx")
    return sequence.vocab_encode(rows, "os", sequence.vocab_fit(train, "os"), "os_idx").select("event_id", "res_idx", "os_idx")


@query("minmax_clip", f"SELECT event_id, {r4('score_seq')} FROM e1")
def minmax_clip(spark, sf):
    rows = derived.scored(spark, sf)
    low, high = scoring.minmax(rows.where(F.col("split") == "val"), "seq_error")
    return rows.select("event_id", scores.minmax_clip(F.col("seq_error"), F.lit(low), F.lit(high)).alias("score_seq"))


@query("minmax_eps", f"SELECT event_id, {r4('score_base')} FROM e1")
def minmax_eps(spark, sf):
    rows = derived.scored(spark, sf)
    low, high = scoring.minmax(rows, "score")
    return rows.select("event_id", scores.minmax_eps(F.col("score"), F.lit(low), F.lit(high)).alias("score_base"))


@query("ensemble_score", f"SELECT event_id, {r4('0.3e0 * score_seq + 0.7e0 * score_base AS score_ensemble')} FROM e1")
def ensemble_score(spark, sf):
    score = scores.ensemble_score(F.col("score_seq"), F.col("score_base"), 0.3, 0.7)
    return derived.scored(spark, sf).select("event_id", score.alias("score_ensemble"))


@query("flag_threshold", "SELECT event_id, CASE WHEN is_anomaly OR score_ensemble >= threshold THEN 1 ELSE 0 END AS flagged FROM en")
def flag_threshold(spark, sf):
    return derived.scored(spark, sf).select("event_id", scoring.is_flagged().cast("int").alias("flagged"))


@query("fill_defaults", f"""SELECT event_id, {r4("CASE WHEN split = 'test' THEN 0.5e0 ELSE score_ensemble END AS score_ensemble",
  "CASE WHEN split = 'test' THEN 0.8e0 ELSE threshold END AS threshold")},
  CASE WHEN split = 'test' THEN 0 ELSE cast(is_anomaly AS integer) END AS is_anomaly FROM en""")
def fill_defaults(spark, sf):
    rows = scoring.with_score_defaults(derived.access_log(spark, sf), derived.scores_before_test(spark, sf))
    return rows.select("event_id", "score_ensemble", "threshold", F.col("is_anomaly").cast("int").alias("is_anomaly"))


@query("binary_label", "SELECT event_id, CASE WHEN label <> 'normal' THEN 1 ELSE 0 END AS y FROM al")
def binary_label(spark, sf):
    return derived.access_log(spark, sf).select("event_id", rules.binary_label(F.col("label")).alias("y"))


@query("target_class", f"SELECT event_id, {TARGET} FROM al")
def target_class(spark, sf):
    return derived.access_log(spark, sf).select("event_id", rules.target_class(F.col("label")).alias("target_class"))


@query("failed_auth_flag", "SELECT event_id, cast(failed AS bigint) AS failed FROM al")
def failed_auth_flag(spark, sf):
    failed = rules.failed_auth(F.col("session_duration"), F.col("auth_method"))
    return derived.access_log(spark, sf).select("event_id", failed.alias("failed"))


RULE_TEXT = """CASE WHEN rule = 'impossible_travel' THEN 'Rule Override: geo_velocity_kmh > 900 km/h AND geo_distance > 500 km'
  WHEN rule = 'brute_force' THEN 'Rule Override: failed_auth_count_5min > 30' END"""


@query("rule_override", f"""SELECT event_id, rule AS attack_type, CASE WHEN rule IS NULL THEN 0.0e0 ELSE 1.0e0 END AS confidence,
  {RULE_TEXT} AS reason FROM rl""")
def rule_override(spark, sf):
    s = derived.signals()
    return derived.features(spark, sf).select(
        "event_id", rules.rule_class(*s).alias("attack_type"), rules.rule_confidence(*s).alias("confidence"),
        rules.rule_text(*s).alias("reason"),
    )


@query("prediction_source", f"SELECT event_id, coalesce({RULE_TEXT}, 'Spark ML Classifier') AS prediction_source FROM rl")
def prediction_source(spark, sf):
    return derived.features(spark, sf).select("event_id", rules.prediction_source(*derived.signals()).alias("prediction_source"))


@query("severity_band", """SELECT event_id, CASE WHEN risk_score >= 0.8 THEN 'critical' WHEN risk_score >= 0.5 THEN 'medium' ELSE 'low' END
  AS severity FROM ra""")
def severity_band(spark, sf):
    return derived.alerts(spark, sf).select("event_id", scores.severity_band(F.col("risk_score")).alias("severity"))


@query("infer_entity_type", """SELECT DISTINCT entity_id, CASE WHEN lower(entity_id) LIKE '%admin%' OR entity_id LIKE '%0' THEN 'admin'
  WHEN lower(entity_id) LIKE '%svc%' OR entity_id LIKE '%1' THEN 'service_account' ELSE 'user' END AS inferred FROM al""")
def infer_entity_type(spark, sf):
    ids = derived.access_log(spark, sf).select("entity_id").distinct()
    return ids.select("entity_id", rules.infer_entity_type(F.col("entity_id")).alias("inferred"))


def masked_reasons(spark, sf):
    """Sentences of alerts that a rule decided; for the others one mark if the sentence is one of the three."""
    return reasons_checked(with_reason(spark, sf)).select("event_id", "top_reason")


@verdicts.shown("top_reason", """SELECT event_id, CASE
  WHEN predicted_attack_type = 'impossible_travel' THEN printf('Geo velocity %.0f km/h (>900 km/h threshold)', geo_velocity_kmh)
  WHEN predicted_attack_type = 'brute_force' THEN printf('Brute force burst (%d failed auths in 5m)', failed_auth_count_5min)
  ELSE '(model)' END AS top_reason FROM ra""", masked_reasons)
def top_reason(spark, sf):
    """The main reason of each alert in a sentence."""
    return with_reason(spark, sf).select("event_id", "top_reason")


def with_reason(spark, sf):
    velocity, distance, failures = derived.signals()
    reason = rules.top_reason(F.col("predicted_attack_type"), velocity, distance, failures, F.col("risk_score"))
    return derived.alerts(spark, sf).withColumn("top_reason", reason)


def reasons_checked(rows):
    """Replace reasons that rest on the classifier by its mark where they are well-formed."""
    known = F.col("top_reason").rlike(r"^(Geo velocity \d+ km/h|Brute force burst \(\d+ failed|High ensembled anomaly score \([01]\.\d\d\))")
    by_model = F.col("prediction_source") == rules.MODEL_TEXT
    return rows.withColumn("top_reason", F.when(by_model & known, F.lit(derived.MODEL_VERDICT)).otherwise(F.col("top_reason")))


TOLD = (*chain.FEATURES, "bytes_transferred", "score_ensemble")
SENTENCE = """CASE feature
  WHEN 'geo_velocity_kmh' THEN printf('Travel velocity of %.1f km/h between consecutive logins exceeds physical speed limits (>900 km/h)', value)
  WHEN 'geo_distance_prev_km' THEN printf('Physical distance of %.1f km from previous login location exceeds physical movement threshold (>500 km)', value)
  WHEN 'failed_auth_count_5min' THEN printf('High frequency of failed authentication attempts (%d failures in 5-minute window)', cast(trunc(value) AS bigint))
  WHEN 'distinct_ip_count_1h' THEN printf('Login requests originating from %d distinct IP addresses within a 1-hour window', cast(trunc(value) AS bigint))
  WHEN 'new_resource_count_1h' THEN printf('Rapid burst of %d novel or atypical resource accesses within a 1-hour window', cast(trunc(value) AS bigint))
  WHEN 'session_duration' THEN printf('Abnormal session duration (%.1fs) compared to historical baseline', value)
  WHEN 'rec_err_duration' THEN printf('Abnormal session duration (%.1fs) compared to historical baseline', value)
  WHEN 'hour_of_day' THEN printf('Login timestamp occurs outside normal entity working hours (hour: %.2f)', value)
  WHEN 'is_weekend' THEN printf('Login timestamp occurs outside normal entity working hours (hour: %.2f)', value)
  WHEN 'rec_err_hour_sin' THEN printf('Login timestamp occurs outside normal entity working hours (hour: %.2f)', value)
  WHEN 'rec_err_hour_cos' THEN printf('Login timestamp occurs outside normal entity working hours (hour: %.2f)', value)
  WHEN 'rec_err_geo_dist' THEN printf('Login location is %.1f km away from historical entity centroid', value)
  WHEN 'geo_distance_from_centroid_km' THEN printf('Login location is %.1f km away from historical entity centroid', value)
  WHEN 'rec_err_resource' THEN 'Access attempt to uncharacteristic or high-privilege resource for entity role'
  WHEN 'resource_novelty' THEN 'Access attempt to uncharacteristic or high-privilege resource for entity role'
  WHEN 'rec_err_auth' THEN 'Unusual authentication method or credential mechanism used'
  WHEN 'auth_password' THEN 'Unusual authentication method or credential mechanism used'
  WHEN 'auth_token' THEN 'Unusual authentication method or credential mechanism used'
  WHEN 'auth_certificate' THEN 'Unusual authentication method or credential mechanism used'
  WHEN 'auth_biometric' THEN 'Unusual authentication method or credential mechanism used'
  WHEN 'rec_err_os' THEN 'Access from an unrecognized device fingerprint or operating system'
  WHEN 'device_fingerprint_hash_novelty' THEN 'Access from an unrecognized device fingerprint or operating system'
  WHEN 'bytes_transferred' THEN concat('Excessive data volume transferred (', format('{:,}', cast(value AS bigint)), ' bytes)')
  WHEN 'score_ensemble' THEN printf('High ensembled anomaly score (%.2f) from combined baseline and sequence models', value)
  WHEN 'profile_decay_factor' THEN printf('Baseline decay factor of %.2f indicates potential concept drift or dormant account activity', value)
  WHEN 'is_cold_start' THEN 'Entity has sparse historical log activity (<5 events), using global population baseline fallback'
  WHEN 'cold_start' THEN 'Entity has sparse historical log activity (<5 events), using global population baseline fallback'
  ELSE concat('Elevated anomaly contribution from feature ''', feature, ''' (value: ', printf('%.2f', value), ')') END"""


@query("feature_narrative", f"SELECT event_id, feature, {SENTENCE} AS narrative FROM (" + " UNION ALL ".join(
    f"SELECT event_id, '{c}' AS feature, cast({c} AS double) AS value FROM ra" for c in TOLD) + ")")
def feature_narrative(spark, sf):
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in TOLD])
    rows = derived.alerts(spark, sf).select("event_id", F.explode(pairs).alias("p")).select("event_id", "p.*")
    return rows.select("event_id", "feature", rules.feature_narrative(F.col("feature"), F.col("value")).alias("narrative"))


@query("audit_trail", "SELECT event_id, CASE WHEN cold THEN 'cold_start=True' ELSE 'cold_start=False' END AS audit_trail FROM lk")
def audit_trail(spark, sf):
    return base(spark, sf).select("event_id", "audit_trail")


def masked_columns(spark, sf):
    alerts = derived.alerts(spark, sf)
    shown = triage.present_columns(alerts).join(alerts.select("event_id", "prediction_source"), "event_id")
    return derived.checkable(reasons_checked(shown).drop("prediction_source"), alerts, "attack_type")


@verdicts.shown("present_columns", f"""SELECT event_id, strftime(make_timestamp(ts_us), '%Y-%m-%d %H:%M:%S') AS timestamp, entity_id, entity_type,
  predicted_attack_type AS attack_type, {r4('risk_score')}, CASE
  WHEN rule = 'impossible_travel' THEN printf('Geo velocity %.0f km/h (>900 km/h threshold)', geo_velocity_kmh)
  WHEN rule = 'brute_force' THEN printf('Brute force burst (%d failed auths in 5m)', failed_auth_count_5min) ELSE '(model)' END AS top_reason FROM ra""", masked_columns)
def present_columns(spark, sf):
    return triage.present_columns(derived.alerts(spark, sf))


@query("filter_normal", "SELECT event_id, entity_id FROM tn")
def filter_normal(spark, sf):
    return profiles.normal_training(derived.learned(spark, sf).events).select("event_id", "entity_id")


@query("filter_flagged", f"SELECT event_id, {TARGET} FROM en WHERE is_anomaly OR score_ensemble >= threshold")
def filter_flagged(spark, sf):
    rows = derived.scored(spark, sf).where(scoring.is_flagged())
    return rows.select("event_id", rules.target_class(F.col("label")).alias("target_class"))


DAY_5, DAY_20 = derived.START_US + 5 * clock.US_PER_DAY, derived.START_US + 20 * clock.US_PER_DAY


@query("queue_filter", f"""SELECT event_id, {r4('risk_score')} FROM ra WHERE ts_us >= {DAY_5} AND ts_us < {DAY_20} + 86400000000
  AND entity_type IN ('user', 'edge_device') AND risk_score >= 0.3""")
def queue_filter(spark, sf):
    kept = triage.queue_filter(derived.alerts(spark, sf), DAY_5, DAY_20, ("user", "edge_device"), (), 0.3)
    return kept.select("event_id", "risk_score")


@query("queue_search", """SELECT event_id, entity_id FROM ra WHERE contains(lower(entity_id), 'usr_0001')
  OR contains(cast(event_id AS varchar), 'usr_0001')""")
def queue_search(spark, sf):
    return triage.queue_search(derived.alerts(spark, sf), " usr_0001 ").select("event_id", "entity_id")


@query("event_lookup", f"SELECT event_id, entity_id, {r4('lat', 'lon')}, label FROM al WHERE event_id = 46")
def event_lookup(spark, sf):
    """One event out of a table laid out for such reads: one folder of ids, then one day."""
    found = stores.stored_event(spark, derived.event_store(spark, sf), 46)
    return found.select("event_id", "entity_id", "lat", "lon", "label")


@query("join_logs_labels", "SELECT event_id, entity_id, label FROM al")
def join_logs_labels(spark, sf):
    logs = derived.access_log(spark, sf).drop("label")
    return readers.join_labels(logs, derived.labels(spark, sf)).select("event_id", "entity_id", "label")


@query("align_labels", "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN label END AS label FROM al")
def align_labels(spark, sf):
    logs = derived.access_log(spark, sf).drop("label")
    return readers.join_labels(logs, derived.labels_with_gaps(spark, sf, 10, 0), "left").select("event_id", "label")


@query("join_scores", f"""SELECT event_id, {r4("CASE WHEN label = 'normal' THEN 0.5e0 ELSE score_ensemble END AS score_ensemble")}, entity_id FROM en""")
def join_scores(spark, sf):
    rows = scoring.with_score_defaults(derived.access_log(spark, sf), derived.scores_of_attacks(spark, sf))
    return rows.select("event_id", "score_ensemble", "entity_id")


@query("profile_lookup", f"""SELECT event_id, owner, {r4('p_lat', 'p_lon', 'p_mean', 'p_std')}, cast(cold AS integer) AS cold_start FROM lk""")
def profile_lookup(spark, sf):
    learned = derived.learned(spark, sf)
    rows = profiles.profile_lookup(learned.events, learned.profiles, learned.everybody, learned.hot)
    names = {"p_home_lat": "p_lat", "p_home_lon": "p_lon", "p_duration_mean": "p_mean", "p_duration_std": "p_std"}
    return rows.select("event_id", "owner", "cold_start", *[F.col(c).alias(n) for c, n in names.items()])


@query("centroid_lookup", f"SELECT event_id, {r4('ce_lat AS c_lat', 'ce_lon AS c_lon', 'geo_distance')} FROM cl")
def centroid_lookup(spark, sf):
    return located(spark, sf).select("event_id", "c_lat", "c_lon", "geo_distance")


@query("join_error_breakdown", "SELECT event_id, " + r4(*[
    f"CASE WHEN split = 'test' THEN 0.0e0 ELSE {c} END AS {c}" for c in sequence.ERROR_COLUMNS]) + " FROM er")
def join_error_breakdown(spark, sf):
    rows = sequence.join_errors(derived.access_log(spark, sf), derived.scores_before_test(spark, sf))
    return rows.select("event_id", *sequence.ERROR_COLUMNS)
