"""Rules, labels and the sentences shown to analysts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
NORMAL = "normal"
UNKNOWN = "unknown"
CLASSES = (
    "normal", "brute_force", "credential_stuffing", "device_spoofing",
    "impossible_travel", "insider_drift", "lateral_movement", "low_slow_exfil",
)
AUTH_METHODS = ("password", "token", "certificate", "biometric")
MAX_VELOCITY_KMH = 900.0
MIN_JUMP_KM = 500.0
MAX_FAILURES = 30
TRAVEL_RULE_TEXT = "Rule Override: geo_velocity_kmh > 900 km/h AND geo_distance > 500 km"
FAILURES_RULE_TEXT = "Rule Override: failed_auth_count_5min > 30"
MODEL_TEXT = "Spark ML Classifier"
TRAVEL_REASON = "Geo velocity %.0f km/h (>900 km/h threshold)"
BURST_REASON = "Brute force burst (%d failed auths in 5m)"
SCORE_REASON = "High ensembled anomaly score (%.2f)"


def failed_auth(duration: Column, auth_method: Column) -> Column:
    """Every password login counts, successful ones too."""
    return F.coalesce((duration == 0) | (auth_method == "password"), F.lit(False)).cast("long")


def auth_flag(auth_method: Column, method: str) -> Column:
    return F.coalesce(auth_method == method, F.lit(False)).cast("int")


def _travel(velocity: Column, distance: Column) -> Column:
    return (velocity > MAX_VELOCITY_KMH) & (distance > MIN_JUMP_KM)


def rule_class(velocity: Column, distance: Column, failures: Column) -> Column:
    """Attack type set by a rule, or NULL."""
    return F.when(_travel(velocity, distance), F.lit("impossible_travel")).when(
        failures > MAX_FAILURES, F.lit("brute_force")
    )


def rule_text(velocity: Column, distance: Column, failures: Column) -> Column:
    return F.when(_travel(velocity, distance), F.lit(TRAVEL_RULE_TEXT)).when(
        failures > MAX_FAILURES, F.lit(FAILURES_RULE_TEXT)
    )


def rule_confidence(velocity: Column, distance: Column, failures: Column) -> Column:
    return F.when(rule_class(velocity, distance, failures).isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))


def prediction_source(velocity: Column, distance: Column, failures: Column) -> Column:
    return F.coalesce(rule_text(velocity, distance, failures), F.lit(MODEL_TEXT))


def binary_label(label: Column) -> Column:
    return (label != NORMAL).cast("int")


def target_class(label: Column) -> Column:
    return F.when(label == NORMAL, F.lit(UNKNOWN)).otherwise(label)


def infer_entity_type(entity_id: Column) -> Column:
    """Entity type read off the id when the feed carries none."""
    low = F.lower(entity_id)
    return (
        F.when(low.contains("admin") | entity_id.endswith("0"), F.lit("admin"))
        .when(low.contains("svc") | entity_id.endswith("1"), F.lit("service_account"))
        .otherwise(F.lit("user"))
    )


def top_reason(attack: Column, velocity: Column, distance: Column, failures: Column, risk: Column) -> Column:
    travel = (attack == "impossible_travel") | _travel(velocity, distance)
    burst = (attack == "brute_force") | (failures > MAX_FAILURES)
    return (
        F.when(travel, F.format_string(TRAVEL_REASON, velocity))
        .when(burst, F.format_string(BURST_REASON, failures))
        .otherwise(F.format_string(SCORE_REASON, risk))
    )


# fixed values: (feature-name parts, whole names, sentence); the first match wins
NARRATIVES = (
    (("geo_velocity",), (),
     "Travel velocity of {1f} km/h between consecutive logins exceeds physical speed limits (>900 km/h)"),
    (("geo_distance_prev",), (),
     "Physical distance of {1f} km from previous login location exceeds physical movement threshold (>500 km)"),
    (("failed_auth",), (), "High frequency of failed authentication attempts ({int} failures in 5-minute window)"),
    (("distinct_ip",), (), "Login requests originating from {int} distinct IP addresses within a 1-hour window"),
    (("new_resource",), (), "Rapid burst of {int} novel or atypical resource accesses within a 1-hour window"),
    (("rec_err_duration",), ("session_duration",),
     "Abnormal session duration ({1f}s) compared to historical baseline"),
    (("rec_err_hour", "hour_of_day", "is_weekend"), (),
     "Login timestamp occurs outside normal entity working hours (hour: {2f})"),
    (("rec_err_geo", "geo_distance_from_centroid"), (),
     "Login location is {1f} km away from historical entity centroid"),
    (("rec_err_resource", "resource_novelty"), (),
     "Access attempt to uncharacteristic or high-privilege resource for entity role"),
    (("rec_err_auth", "auth_"), (), "Unusual authentication method or credential mechanism used"),
    (("rec_err_os", "device_fingerprint"), (),
     "Access from an unrecognized device fingerprint or operating system"),
    (("bytes_transferred",), (), "Excessive data volume transferred ({comma} bytes)"),
    (("score_ensemble",), (),
     "High ensembled anomaly score ({2f}) from combined baseline and sequence models"),
    (("profile_decay_factor",), (),
     "Baseline decay factor of {2f} indicates potential concept drift or dormant account activity"),
    (("is_cold_start", "cold_start"), (),
     "Entity has sparse historical log activity (<5 events), using global population baseline fallback"),
)


def _sentence(template: str, value: Column) -> Column:
    formats = {
        "{1f}": lambda: F.format_string("%.1f", value),
        "{2f}": lambda: F.format_string("%.2f", value),
        "{int}": lambda: value.cast("long").cast("string"),
        "{comma}": lambda: F.format_string("%,.0f", value),
    }
    for mark, text in formats.items():
        if mark in template:
            before, after = template.split(mark)
            return F.concat(F.lit(before), text(), F.lit(after))
    return F.lit(template)


def feature_narrative(feature: Column, value: Column) -> Column:
    """Plain sentence for one (feature, value) pair."""
    name, number = F.lower(feature), value.cast("double")
    case = None
    for parts, whole, template in NARRATIVES:
        hit = F.lit(False)
        for part in parts:
            hit = hit | name.contains(part)
        for word in whole:
            hit = hit | (name == word)
        case = F.when(hit, _sentence(template, number)) if case is None else case.when(hit, _sentence(template, number))
    default = F.concat(
        F.lit("Elevated anomaly contribution from feature '"), feature, F.lit("' (value: "),
        F.format_string("%.2f", number), F.lit(")"),
    )
    return case.otherwise(default)
