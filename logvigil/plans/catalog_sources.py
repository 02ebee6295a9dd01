"""Sources and sinks: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from logvigil.functions.clock import iso_text
from logvigil.operators import chain, scoring, triage
from logvigil.plans import derived, verdicts
from logvigil.plans.oracle import r4
from logvigil.plans.registry import query
from logvigil.session import scratch_dir
from logvigil.sources import readers, schema, writers

ISO = "strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ')"
LOG = "cast(event_id AS varchar) AS event_id, entity_id, entity_type, source_ip, resource_accessed, auth_method, session_duration, bytes_transferred"


def _csv(df, spark):
    path = scratch_dir(spark)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("src_logs", f"""SELECT {LOG}, {r4('lat', 'lon')}, mac, os, ts_us,
  CASE WHEN event_id % 5 = 0 THEN 'sudo su|' || resource_accessed END AS commands FROM al""")
def src_logs(spark, sf):
    logs = readers.load_access_logs(spark, _csv(derived.raw_logs(spark, sf), spark))
    return logs.withColumn("commands", F.array_join("command_sequence", "|")).drop("command_sequence")


@query("src_labels", "SELECT cast(event_id AS varchar) AS event_id, label FROM al")
def src_labels(spark, sf):
    return readers.read_labels(spark, _csv(derived.labels(spark, sf), spark)).select("event_id", "label")


@query("src_scores", f"SELECT event_id, {r4('score_ensemble', 'threshold')}, is_anomaly FROM en")
def src_scores(spark, sf):
    path = scratch_dir(spark)
    writers.write_table(derived.scored(spark, sf), path)
    return readers.read_scores(spark, path, ("event_id", "score_ensemble", "threshold", "is_anomaly"))


@verdicts.shown("src_live_jsonl", f"""SELECT cast(event_id AS varchar) AS event_id, {ISO} AS timestamp, entity_id, predicted_attack_type,
  {r4('risk_score')} FROM ra""")
def src_live_jsonl(spark, sf):
    rows = writers.live_rows(derived.alerts(spark, sf))
    good = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    noise = rows.select(F.explode(F.array(F.lit(""), F.concat(F.lit('{"event_id": "'), "event_id"))).alias("value"))
    path = scratch_dir(spark)
    good.unionByName(noise).write.text(path)
    return readers.read_live_alerts(spark, path)


WINDOW_30D = "OVER (ORDER BY ts_us RANGE BETWEEN 2591999999999 PRECEDING AND CURRENT ROW)"


@query("snk_scores", f"""SELECT event_id, {r4('score_seq', 'score_base', 'score_ensemble', 'threshold',
  'greatest(0.0e0, least(1.0e0, (score_ensemble - lo) / CASE WHEN hi = lo THEN 1.0e0 ELSE hi - lo END)) AS score_rolling_ensemble')}, is_anomaly
  FROM (SELECT *, min(score_ensemble) {WINDOW_30D} AS lo, max(score_ensemble) {WINDOW_30D} AS hi FROM en)""")
def snk_scores(spark, sf):
    path = scratch_dir(spark)
    writers.write_table(derived.scored(spark, sf), path, schema.ENSEMBLE_SCORE_COLUMNS)
    return spark.read.parquet(path)


@query("snk_base_scores", f"""SELECT event_id, {r4('score')}, {r4('t.threshold AS threshold')}, score >= t.threshold AS is_anomaly,
  cold AS cold_start FROM bs CROSS JOIN (SELECT quantile_cont(score, 0.99) AS threshold FROM bs WHERE split = 'val') t""")
def snk_base_scores(spark, sf):
    scores = chain.base_scores(derived.learned(spark, sf)).select("event_id", "split", "score", "cold_start")
    held = derived.written(scores)
    (threshold,) = scoring.exact_percentile(held.where(F.col("split") == "val"), "score", 0.99)
    rows = scoring.add_flag(held, threshold).withColumn("cold_start", F.col("cold_start") == 1)
    path = scratch_dir(spark)
    writers.write_table(rows, path, schema.BASE_SCORE_COLUMNS)
    return spark.read.parquet(path)


@verdicts.shown("snk_predictions", f"""SELECT event_id, {ISO} AS timestamp, entity_id, label,
  CASE WHEN label = 'normal' THEN 'unknown' ELSE label END AS target_class, predicted_attack_type,
  CASE WHEN rule = 'impossible_travel' THEN 'Rule Override: geo_velocity_kmh > 900 km/h AND geo_distance > 500 km'
       WHEN rule = 'brute_force' THEN 'Rule Override: failed_auth_count_5min > 30' ELSE 'Spark ML Classifier' END AS prediction_source
  FROM ra""")
def snk_predictions(spark, sf):
    path = scratch_dir(spark)
    writers.write_predictions(derived.alerts(spark, sf), path)
    return spark.read.parquet(path)


PROFILE_SQL = f"""SELECT entity_id, num_events, {r4('home_lat', 'home_lon', 'avg_radius', 'duration_mean', 'duration_std')}, last_ts_us,
  resources, minutes FROM pb JOIN pr USING (entity_id)
  JOIN (SELECT entity_id, string_agg(resource_accessed, ',' ORDER BY rank) AS resources FROM tr GROUP BY entity_id) USING (entity_id)
  JOIN (SELECT owner AS entity_id, string_agg(concat(md, ':', n), ',' ORDER BY md) AS minutes FROM eh GROUP BY owner) USING (entity_id)"""


def flat_profile(profile, hours=False):
    """Arrays as text, for comparison; ``hours`` keeps the spread of the hour."""
    pair = F.transform("minutes", lambda m: F.concat_ws(":", m["minute"].cast("string"), m["n"].cast("string")))
    return profile.withColumn("resources", F.array_join("typical_resources", ",")).withColumn(
        "minutes", F.array_join(pair, ",")
    ).drop("typical_resources", *([] if hours else ["hour_std", "hour_var"]))


@query("snk_profiles", PROFILE_SQL)
def snk_profiles(spark, sf):
    path = scratch_dir(spark)
    writers.write_table(derived.learned(spark, sf).profiles, path)
    return flat_profile(spark.read.parquet(path))


@query("snk_feature_cache", f"""SELECT event_id, {r4('norm_session_duration', 'geo_velocity_kmh', 'rec_err_resource', 'score_ensemble')},
  failed_auth_count_5min FROM cf""")
def snk_feature_cache(spark, sf):
    path = scratch_dir(spark)
    columns = ("event_id", "norm_session_duration", "geo_velocity_kmh", "rec_err_resource", "score_ensemble", "failed_auth_count_5min")
    for _ in range(2):  # the second call only reads
        cached = writers.cached_table(
            spark, path, lambda: derived.features(spark, sf).select(*columns), inputs=[f"{sf}/events.parquet"], columns=columns
        )
    return cached


@verdicts.shown("snk_feedback", f"""SELECT {ISO} AS timestamp, cast(event_id AS varchar) AS event_id,
  CASE WHEN part = 0 THEN 'False Positive' ELSE 'Confirm Attack (True Positive)' END AS analyst_action,
  predicted_attack_type, {r4('risk_score')}, concat('note ', part) AS comments
  FROM ra JOIN (SELECT 0 AS part UNION ALL SELECT 1) ON (label = 'normal') = (part = 0)""")
def snk_feedback(spark, sf):
    path = scratch_dir(spark)
    rows = derived.alerts(spark, sf).withColumn("timestamp", iso_text(F.col("ts_us")))
    parts = (("False Positive", F.col("label") == "normal"), ("Confirm Attack (True Positive)", F.col("label") != "normal"))
    for part, (action, mine) in enumerate(parts):
        decided = rows.where(mine).withColumn("analyst_action", F.lit(action)).withColumn("comments", F.lit(f"note {part}"))
        for _ in range(2):  # a write that is repeated
            writers.log_feedback(decided, path)
    return readers.read_feedback(spark, path).select(*[f.name for f in schema.FEEDBACK])


@query("queue_decisions", f"""SELECT event_id, {r4('risk_score')}, CASE WHEN event_id % 3 = 0 THEN NULL
  WHEN label = 'normal' THEN 'False Positive' ELSE 'Confirm Attack (True Positive)' END AS analyst_action, event_id % 3 = 0 AS open FROM ra""")
def queue_decisions(spark, sf):
    """The queue with the last decision on each alert: all decided ones are first called false, and attacks confirmed an hour later."""
    path = scratch_dir(spark)
    rows = derived.alerts(spark, sf)
    decided = rows.where("event_id % 3 <> 0").withColumn("comments", F.lit(None).cast("string"))
    hour = 3_600_000_000
    parts = (("False Positive", F.lit(True), 0), ("Confirm Attack (True Positive)", F.col("label") != "normal", hour))
    for action, mine, later in parts:
        said = decided.where(mine).withColumns({"analyst_action": F.lit(action), "timestamp": iso_text(F.col("ts_us") + later)})
        writers.log_feedback(said, path)
    return triage.with_decisions(rows, readers.read_feedback(spark, path)).select("event_id", "risk_score", "analyst_action", "open")


@verdicts.shown("snk_live_jsonl", f"""SELECT cast(event_id AS varchar) AS event_id, {ISO} AS timestamp, entity_id, predicted_attack_type,
  {r4('risk_score')} FROM ra""")
def snk_live_jsonl(spark, sf):
    path = scratch_dir(spark)
    writers.write_live_alerts(derived.alerts(spark, sf), path)
    return readers.read_live_alerts(spark, path)
