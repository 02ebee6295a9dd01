import pytest
from clock_rows import DAY, SECOND, T0
from pyspark.sql import functions as F

from logvigil.functions.rules import CLASSES
from logvigil.operators import audit, detect, triage


def verdict(df):
    row = df.first()
    return row["passed"], row["found"]


def test_nulls(spark, log):
    clean = log([{}, {"sec": 9}]).withColumns({"timestamp": F.lit("t"), "geo_location": F.lit("{}"), "device_fingerprint": F.lit("{}")})
    assert verdict(audit.dq_nulls(clean)) == (1, 0.0)
    dirty = clean.withColumn("entity_id", F.when(F.col("event_id") == 0, F.lit(""))).withColumn("timestamp", F.lit(None).cast("string"))
    assert verdict(audit.dq_nulls(dirty)) == (0, 4.0)
    assert verdict(audit.dq_nulls(clean.drop("source_ip", "timestamp"))) == (0, 2.0)


def test_alignment(log):
    rows = log([{}, {}, {}])
    assert verdict(audit.dq_alignment(rows, rows)) == (1, 0.0)
    assert verdict(audit.dq_alignment(rows, rows.where("event_id > 0"))) == (0, 1.0)
    assert verdict(audit.dq_alignment(rows, rows.unionByName(rows.where("event_id = 2")))) == (0, 1.0)


@pytest.mark.parametrize(("odd", "passed"), [(1, 0), (3, 1), (5, 1), (6, 0)])
def test_anomaly_rate(log, odd, passed):
    rows = log([{"label": "brute_force" if i < odd else "normal"} for i in range(200)])
    assert verdict(audit.dq_anomaly_rate(rows)) == (passed, odd / 2)


def test_taxonomy(log):
    rows = log([{"label": c} for c in CLASSES])
    assert verdict(audit.dq_taxonomy(rows)) == (1, 0.0)
    assert verdict(audit.dq_taxonomy(rows.where("label <> 'insider_drift'"))) == (0, 1.0)


def test_timeline_checks(log):
    far = {"lat": 40.0}
    rows = log([
        {"ts_us": T0}, {"ts_us": T0 + 999},  # less than a millisecond apart
        {"sec": 3600, **far}, {"sec": 7200, "label": "impossible_travel"}, {"sec": 7300, **far, "label": "impossible_travel"},
        {"sec": 90_000_0, "label": "impossible_travel"},
    ])
    assert verdict(audit.dq_chronology(rows)) == (0, 1.0)
    assert verdict(audit.dq_benign_velocity(rows)) == (0, 1.0)
    passed, share = verdict(audit.dq_travel_constraint(rows))
    assert passed == 0 and share == pytest.approx(2 / 3)
    calm = log([{"sec": 0}, {"sec": 60}])
    assert [verdict(check(calm)) for check in (audit.dq_chronology, audit.dq_benign_velocity, audit.dq_travel_constraint)] == [(1, 0.0), (1, 0.0), (1, 1.0)]


def test_brute_force(log):
    burst = [{"sec": i * 0.5, "auth_method": "password", "session_duration": 0, "source_ip": "6.6.6.6"} for i in range(60)]
    quiet = [{"sec": 3600 * i, "auth_method": "password", "session_duration": 0} for i in range(60)]
    got = detect.brute_force(log(burst + quiet)).collect()
    assert [(r["source_ip"], r["attempts"]) for r in got] == [("6.6.6.6", 60)]


def test_credential_stuffing(log):
    attack = [{"sec": i, "entity_id": f"E{i % 40}", "auth_method": "password", "session_duration": 0 if i % 5 else 300, "source_ip": "bad"} for i in range(100)]
    office = [{"sec": i, "entity_id": f"E{i % 40}", "auth_method": "password", "session_duration": 300, "source_ip": "nat"} for i in range(100)]
    (row,) = detect.credential_stuffing(log(attack + office)).collect()
    assert (row["source_ip"], row["entities"], row["attempts"], row["fail_share"]) == ("bad", 40, 100, 0.8)


def test_lateral_movement(spark, log):
    typical = spark.createDataFrame([("USR_1", "r0"), ("USR_2", "r0")], "entity_id string, resource_accessed string")
    fast = [{"sec": 30 * i, "resource_accessed": f"r{i}"} for i in range(7)]
    slow = [{"sec": 4000 * i, "entity_id": "USR_2", "resource_accessed": f"r{i}"} for i in range(7)]
    got = detect.lateral_movement(log(fast + slow), typical).collect()
    assert {(r["event_id"], r["new_resource_count_1h"]) for r in got} == {(5, 5), (6, 6)}


def test_device_spoofing(log):
    known = log([{}, {"entity_id": "USR_2", "mac": "m2", "os": "o2"}])
    probe = log([{"mac": "mx", "os": "ox"}, {"mac": "mx"}, {"os": "ox"}, {"entity_id": "NEW", "mac": "mx", "os": "ox"}])
    macs, systems = known.select("entity_id", "mac").distinct(), known.select("entity_id", "os").distinct()
    assert [r["event_id"] for r in detect.device_spoofing(probe, macs, systems).collect()] == [0]


def test_low_slow_exfil(log):
    vault = {"resource_accessed": "/vault/secrets/api_keys", "bytes_transferred": 10}
    leak = [{"ts_us": T0 + d * DAY + 2 * 3600 * SECOND, **vault} for d in range(0, 32, 2)]
    day = [{"ts_us": T0 + d * DAY + 12 * 3600 * SECOND, "entity_id": "USR_2", **vault} for d in range(30)]
    got = {r["day"] - T0 // DAY: (r["active_days"], r["bytes"]) for r in detect.low_slow_exfil(log(leak + day)).collect()}
    assert got == {26: (14, 140), 28: (14, 140), 30: (14, 140)}


def test_insider_drift(spark, log):
    typical = spark.createDataFrame([("USR_1", "r0"), ("USR_2", "r0")], "entity_id string, resource_accessed string")
    rows = []
    for week in range(4):
        for i in range(4):
            rows.append({"ts_us": T0 + (7 * week + 3) * DAY + i, "resource_accessed": "new" if i < week else "r0"})
            rows.append({"ts_us": T0 + (7 * week + 3) * DAY + i, "entity_id": "USR_2", "resource_accessed": "new" if i < 2 else "r0"})
    (row,) = detect.insider_drift(log(rows), typical).collect()
    assert row["entity_id"] == "USR_1" and row["slope"] == pytest.approx(0.25) and row["max_share"] == 0.75


def alerts(log):
    rows = [{"ts_us": T0 + i * DAY, "entity_id": f"USR_{i % 3}", "entity_type": "user" if i % 2 else "edge_device"} for i in range(60)]
    return log(rows).withColumn("risk_score", F.col("event_id") / 60).withColumn("predicted_attack_type", F.lit("unknown"))


def test_queue(log):
    queue = alerts(log)
    day = triage.queue_filter(queue, T0 + 40 * DAY, T0 + 42 * DAY, min_risk=0.0)
    assert sorted(r["event_id"] for r in day.collect()) == [40, 41, 42]
    assert triage.queue_filter(queue, entity_types=["user"], attacks=["unknown"]).count() == 15
    assert triage.queue_filter(queue, attacks=["brute_force"]).count() == 0
    assert triage.queue_search(queue, " uSr_2 ").count() == 20 and triage.queue_search(queue, "  ").count() == 60
    assert triage.queue_search(queue, "u.r").count() == 0  # the text is literal
    assert [r["event_id"] for r in triage.queue_page(queue, 3).collect()] == list(range(9, -1, -1))
    assert triage.page_count(queue).first()["pages"] == 3 and triage.page_count(queue.limit(0)).first()["pages"] == 1
    assert tuple(triage.kpi_counts(queue).first()) == (12, 18)


def test_unknown_event_is_an_error(log):
    with pytest.raises(ValueError, match="no event"):
        triage.event_lookup(alerts(log), 99)
