"""Data-quality checks and attack detectors."""

from __future__ import annotations

from logvigil.operators import audit, detect, profiles
from logvigil.plans import derived
from logvigil.plans.catalog_aggregates import normal
from logvigil.plans.oracle import VELOCITY, r4
from logvigil.plans.registry import query


def _verdict(check: str, passed: str, found: str, source: str) -> str:
    return f"SELECT '{check}' AS \"check\", CASE WHEN {passed} THEN 1 ELSE 0 END AS passed, round(cast({found} AS double) + 1e-9, 4) AS found FROM ({source})"


STEP = f"""SELECT *, {VELOCITY} AS kmh FROM gv WHERE sec > p_sec"""
CHECKS_SQL = {
    "dq_nulls": _verdict("no_missing_values", "n = 0", "n", """SELECT count(*) AS n FROM al WHERE event_id IS NULL OR entity_id = ''
      OR resource_accessed IS NULL OR auth_method IS NULL OR session_duration IS NULL OR bytes_transferred IS NULL OR source_ip = ''"""),
    "dq_alignment": _verdict("labels_aligned", "n = 0", "n", """SELECT count(*) AS n FROM al a FULL JOIN
      (SELECT event_id FROM al WHERE event_id % 1000 <> 7) b ON a.event_id = b.event_id WHERE a.event_id IS NULL OR b.event_id IS NULL"""),
    "dq_anomaly_rate": _verdict("anomaly_rate", "abs(r - 2) <= 0.5", "r", "SELECT avg(CASE WHEN label <> 'normal' THEN 100.0e0 ELSE 0 END) AS r FROM al"),
    "dq_taxonomy": _verdict("all_classes_present", "n = 0", "n", "SELECT 8 - count(DISTINCT label) AS n FROM al"),
    "dq_chronology": _verdict("increasing_time", "n = 0", "n", "SELECT count(*) AS n FROM lg WHERE ts_us - p_ts < 1000"),
    "dq_benign_velocity": _verdict("benign_velocity", "n = 0", "n",
                                   f"SELECT count(*) AS n FROM ({STEP}) WHERE label = 'normal' AND p_label = 'normal' AND kmh > 500 AND km > 50"),
    "dq_travel_constraint": _verdict("travel_constraint", "s >= 0.8", "s", f"""SELECT (SELECT count(*) FROM ({STEP})
      WHERE label = 'impossible_travel' AND km > 500 AND kmh > 900) / (SELECT count(*) * 1.0e0 FROM al WHERE label = 'impossible_travel') AS s"""),
}


@query("dq_nulls", CHECKS_SQL["dq_nulls"])
def dq_nulls(spark, sf):
    return audit.dq_nulls(derived.raw_logs(spark, sf))


@query("dq_alignment", CHECKS_SQL["dq_alignment"])
def dq_alignment(spark, sf):
    return audit.dq_alignment(derived.access_log(spark, sf), derived.labels_with_gaps(spark, sf, 1000, 7))


@query("dq_anomaly_rate", CHECKS_SQL["dq_anomaly_rate"])
def dq_anomaly_rate(spark, sf):
    return audit.dq_anomaly_rate(derived.labels(spark, sf))


@query("dq_taxonomy", CHECKS_SQL["dq_taxonomy"])
def dq_taxonomy(spark, sf):
    return audit.dq_taxonomy(derived.labels(spark, sf))


@query("dq_chronology", CHECKS_SQL["dq_chronology"])
def dq_chronology(spark, sf):
    return audit.dq_chronology(derived.access_log(spark, sf))


@query("dq_benign_velocity", CHECKS_SQL["dq_benign_velocity"])
def dq_benign_velocity(spark, sf):
    return audit.dq_benign_velocity(derived.access_log(spark, sf))


@query("dq_travel_constraint", CHECKS_SQL["dq_travel_constraint"])
def dq_travel_constraint(spark, sf):
    return audit.dq_travel_constraint(derived.access_log(spark, sf))


@query("dq_audit", " UNION ALL ".join(
    s.replace(" WHERE event_id % 1000 <> 7", "") for s in CHECKS_SQL.values()))
def dq_audit(spark, sf):
    return audit.audit(derived.raw_logs(spark, sf), derived.access_log(spark, sf), derived.labels(spark, sf))


BURST = "ts_us // 600000000 * 600000000"
HALF_HOUR = "ts_us // 1800000000 * 1800000000"


@query("detect_brute_force", f"""SELECT entity_id, source_ip, {BURST} AS window_us, count(*) AS attempts FROM ak
  WHERE session_duration = 0 AND auth_method = 'password' GROUP BY entity_id, source_ip, {BURST} HAVING count(*) >= 50""")
def detect_brute_force(spark, sf):
    return detect.brute_force(derived.attack_log(spark, sf))


@query("detect_impossible_travel", f"""SELECT event_id, entity_id, {r4('geo_velocity_kmh', 'km AS geo_distance_prev_km')}
  FROM (SELECT *, {VELOCITY} AS geo_velocity_kmh FROM gv) WHERE geo_velocity_kmh > 900 AND km > 500""")
def detect_impossible_travel(spark, sf):
    rows = detect.impossible_travel(derived.access_log(spark, sf))
    return rows.select("event_id", "entity_id", "geo_velocity_kmh", "geo_distance_prev_km")


@query("detect_credential_stuffing", f"""SELECT source_ip, {HALF_HOUR} AS window_us, count(DISTINCT entity_id) AS entities, count(*) AS attempts,
  count(*) FILTER (session_duration = 0) AS failed, {r4('avg(CASE WHEN session_duration = 0 THEN 1.0e0 ELSE 0.0e0 END) AS fail_share')}
  FROM ak WHERE auth_method = 'password' GROUP BY source_ip, {HALF_HOUR}
  HAVING count(DISTINCT entity_id) >= 20 AND avg(CASE WHEN session_duration = 0 THEN 1.0e0 ELSE 0.0e0 END) >= 0.8e0""")
def detect_credential_stuffing(spark, sf):
    return detect.credential_stuffing(derived.attack_log(spark, sf))


@query("detect_lateral_movement", "SELECT event_id, entity_id, new_resource_count_1h FROM nk WHERE new_resource_count_1h >= 5")
def detect_lateral_movement(spark, sf):
    typical = profiles.typical_pairs(derived.learned(spark, sf).profiles)
    rows = detect.lateral_movement(derived.attack_log(spark, sf), typical)
    return rows.select("event_id", "entity_id", "new_resource_count_1h")


@query("detect_device_spoofing", """SELECT event_id, entity_id, mac, os FROM al WHERE entity_id IN (SELECT entity_id FROM tn)
  AND (entity_id, mac) NOT IN (SELECT entity_id, mac FROM tn) AND (entity_id, os) NOT IN (SELECT entity_id, os FROM tn)""")
def detect_device_spoofing(spark, sf):
    known = normal(spark, sf)
    rows = detect.device_spoofing(
        derived.access_log(spark, sf), profiles.distinct_values(known, "mac"), profiles.distinct_values(known, "os")
    )
    return rows.select("event_id", "entity_id", "mac", "os")


@query("detect_low_slow_exfil", """SELECT * FROM (SELECT entity_id, day, cast(sum(b) OVER w AS bigint) AS bytes, cast(sum(r) OVER w AS bigint) AS reads,
  count(*) OVER w AS active_days FROM (SELECT entity_id, ts_us // 86400000000 AS day, sum(bytes_transferred) AS b, count(*) AS r FROM ak
  WHERE resource_accessed IN ('/vault/secrets/api_keys', '/backup/nightly_dump.tar.gz') AND ts_us % 86400000000 >= 3600000000
  AND ts_us % 86400000000 < 14400000000 GROUP BY ALL)
  WINDOW w AS (PARTITION BY entity_id ORDER BY day RANGE BETWEEN 27 PRECEDING AND CURRENT ROW)) WHERE active_days >= 14""")
def detect_low_slow_exfil(spark, sf):
    return detect.low_slow_exfil(derived.attack_log(spark, sf))


@query("detect_insider_drift", f"""SELECT entity_id, count(*) AS weeks, {r4('regr_slope(share, week) AS slope', 'max(share) AS max_share')} FROM (
  SELECT al.entity_id, ts_us // 604800000000 AS week, avg(CASE WHEN tr.entity_id IS NULL THEN 1.0e0 ELSE 0.0e0 END) AS share FROM al
  LEFT JOIN tr ON tr.entity_id = al.entity_id AND tr.resource_accessed = al.resource_accessed GROUP BY ALL)
  GROUP BY entity_id HAVING count(*) >= 3 AND round(regr_slope(share, week), 9) > 0""")
def detect_insider_drift(spark, sf):
    typical = profiles.typical_pairs(derived.learned(spark, sf).profiles)
    return detect.insider_drift(derived.access_log(spark, sf), typical)
