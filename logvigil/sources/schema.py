"""Declared schemas: nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

GEO = T.StructType(
    [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()), T.StructField("country", T.StringType())]
)
DEVICE = T.StructType([T.StructField(n, T.StringType()) for n in ("os", "firmware", "mac", "protocol")])

ACCESS_LOG = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("geo_location", T.StringType()),
        T.StructField("resource_accessed", T.StringType()),
        T.StructField("auth_method", T.StringType()),
        T.StructField("session_duration", T.LongType()),
        T.StructField("bytes_transferred", T.LongType()),
        T.StructField("command_sequence", T.StringType()),
        T.StructField("device_fingerprint", T.StringType()),
    ]
)
LABELS = T.StructType([T.StructField(n, T.StringType()) for n in ("event_id", "label", "attack_scenario_id")])
ENTITY = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("home_ip", T.StringType()),
        T.StructField("home_geo", GEO),
        T.StructField("created_at", T.StringType()),
    ]
)
LIVE_ALERT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("event_id", "timestamp", "entity_id", "predicted_attack_type")]
    + [T.StructField("risk_score", T.DoubleType())]
)
FEEDBACK = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("analyst_action", T.StringType()),
        T.StructField("predicted_attack_type", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("comments", T.StringType()),
    ]
)

# fixed values
BASE_SCORE_COLUMNS = ("event_id", "score", "threshold", "is_anomaly", "cold_start")
ENSEMBLE_SCORE_COLUMNS = (
    "event_id", "score_seq", "score_base", "score_ensemble", "score_rolling_ensemble", "threshold", "is_anomaly",
)
PREDICTION_COLUMNS = (
    "event_id", "timestamp", "entity_id", "label", "target_class", "predicted_attack_type", "prediction_source",
)
