import pytest
from clock_rows import DAY, T0
from pyspark.sql import functions as F

from logvigil.functions import clock, rules


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("velocity", "distance", "failures", "want"),
    [
        (1000.0, 600.0, 31, "impossible_travel"),
        (900.0, 600.0, 0, None),
        (1000.0, 500.0, 30, None),
        (1000.0, 500.0, 31, "brute_force"),
        (0.0, 0.0, 31, "brute_force"),
    ],
)
def test_rules(spark, velocity, distance, failures, want):
    signals = [F.lit(velocity), F.lit(distance), F.lit(failures)]
    attack, confidence, text, source = one(
        spark, rules.rule_class(*signals), rules.rule_confidence(*signals), rules.rule_text(*signals), rules.prediction_source(*signals)
    )
    assert attack == want and confidence == (1.0 if want else 0.0)
    assert (text is None) == (want is None) and source == (text or "Spark ML Classifier")


@pytest.mark.parametrize(
    ("feature", "value", "part"),
    [
        ("geo_velocity_kmh", 1234.56, "Travel velocity of 1234.6 km/h"),
        ("failed_auth_count_5min", 31.9, "(31 failures in 5-minute window)"),
        ("session_duration", 5.0, "Abnormal session duration (5.0s)"),
        ("norm_session_duration", 5.0, "feature 'norm_session_duration' (value: 5.00)"),
        ("auth_password", 1.0, "Unusual authentication method"),
        ("failed_auth_rate", 2.0, "High frequency of failed"),  # the first matching part wins
        ("bytes_transferred", 1234567.0, "(1,234,567 bytes)"),
        ("rec_err_os", 0.1, "unrecognized device fingerprint"),
        ("is_cold_start", 1.0, "sparse historical log activity"),
    ],
)
def test_narratives(spark, feature, value, part):
    assert part in one(spark, rules.feature_narrative(F.lit(feature), F.lit(value)))[0]


def test_top_reason(spark):
    def reason(attack, velocity, distance, failures, risk):
        return one(spark, rules.top_reason(F.lit(attack), F.lit(velocity), F.lit(distance), F.lit(failures), F.lit(risk)))[0]

    assert reason("unknown", 950.0, 600.0, 40, 0.9) == "Geo velocity 950 km/h (>900 km/h threshold)"
    assert reason("unknown", 950.0, 400.0, 40, 0.9) == "Brute force burst (40 failed auths in 5m)"
    assert reason("unknown", 1.0, 1.0, 4, 0.916) == "High ensembled anomaly score (0.92)"


@pytest.mark.parametrize(("entity", "want"), [("x_ADMIN_7", "admin"), ("USR_0010", "admin"), ("svc_12", "service_account"), ("USR_0011", "service_account"), ("USR_0012", "user")])
def test_entity_type(spark, entity, want):
    assert one(spark, rules.infer_entity_type(F.lit(entity))) == (want,)


def test_clock_ignores_the_session_zone(spark):
    ts = F.lit(T0 + 5 * DAY + (13 * 3600 + 45 * 60 + 36) * 1_000_000 + 7)
    columns = [clock.day_of_week(ts), clock.is_weekend(ts), clock.hour_of_day(ts), clock.exact_hour(ts), clock.iso_text(ts)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, *columns, clock.parse_iso(F.lit("2024-01-06T13:45:36.000007")), clock.parse_iso(F.lit("2024-01-06T15:45:36.000007+02:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    when = T0 + 5 * DAY + (13 * 3600 + 45 * 60 + 36) * 1_000_000 + 7
    assert got[:2] == (5, 1) and got[2] == 13.75 and got[3] == pytest.approx(13.76)
    assert got[4:] == ("2024-01-06T13:45:36.000007Z", when, when)


def test_unreadable_time_is_null(spark):
    assert one(spark, clock.parse_iso(F.lit("no time"))) == (None,)
