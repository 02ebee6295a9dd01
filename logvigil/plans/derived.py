"""The access log derived from the driver's ``events`` table.

Integer arithmetic only, so that every engine derives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.functions import rules
from logvigil.functions.clock import iso_text
from logvigil.operators import chain, models, scoring
from logvigil.session import scratch_dir, written
from logvigil.sources import stores

# fixed values: 2024-01-01 UTC in microseconds
START_US = 1704067200000000


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: ids, ``ts_us``, place, resource, login method, sizes, device, label."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.select(
        F.col("event_id"),
        F.col("user_id").alias("u"),
        F.col("event_type").alias("et"),
        F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.expr(
            "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', cast(ts as timestamp_ntz))"
        ).alias("off"),
    )
    return base.selectExpr(
        "event_id",
        "concat(CASE WHEN u % 20 < 14 THEN 'USR_' WHEN u % 20 < 17 THEN 'SRV_' ELSE 'DEV_' END,"
        " lpad(cast(u AS string), 5, '0')) AS entity_id",
        "CASE WHEN u % 20 < 14 THEN 'user' WHEN u % 20 < 17 THEN 'service_account' ELSE 'edge_device' END"
        " AS entity_type",
        f"{START_US} + CASE WHEN u % 25 = 0 THEN (u % 30) * 86400000000 + off div 8640 ELSE off END AS ts_us",
        "CASE WHEN event_id % 23 = 0 THEN concat('203.0.113.', cast(event_id % 200 AS string))"
        " ELSE concat('10.', cast(u % 256 AS string), '.0.', cast(event_id % 3 AS string)) END AS source_ip",
        "cast((u * 37) % 140 - 70 AS double) + cast((event_id * 13) % 100 - 50 AS double) / 1000.0D"
        " + CASE WHEN event_id % 23 = 0 THEN 15.0D ELSE 0.0D END AS lat",
        "cast(((u * 91) % 360 + CASE WHEN event_id % 23 = 0 THEN 25 ELSE 0 END) % 360 - 180 AS double) AS lon",
        "concat('res_', lpad(cast(CASE WHEN k < 70 THEN (u + k % 5) % 12 ELSE (u * 7 + k) % 12 END AS string), 2, '0'))"
        " AS resource_accessed",
        "CASE et WHEN 'click' THEN 'password' WHEN 'error' THEN 'password' WHEN 'view' THEN 'token'"
        " WHEN 'signup' THEN 'certificate' ELSE 'biometric' END AS auth_method",
        "CASE WHEN et = 'error' THEN 0 ELSE cast(floor(v * 10) AS bigint) END AS session_duration",
        "cast(floor(v * 1000) AS bigint) + 100 AS bytes_transferred",
        "CASE WHEN event_id % 101 = 0 THEN concat('mac_new_', cast(event_id AS string))"
        " ELSE concat('mac_', cast(u AS string), '_', cast(event_id % 2 AS string)) END AS mac",
        "CASE WHEN event_id % 101 = 0 THEN 'os_x' ELSE concat('os_', cast(u % 6 AS string)) END AS os",
        "CASE WHEN u % 25 = 0 THEN 'brute_force' WHEN event_id % 23 = 0 THEN 'impossible_travel'"
        " WHEN event_id % 101 = 0 THEN 'device_spoofing' ELSE 'normal' END AS label",
    )


# Damaged inputs, so that defaults and checks have something to show. The operators run over all of each.


def labels_with_gaps(spark: SparkSession, sf_dir: str, every: int, at: int) -> DataFrame:
    """A label table in which the row of each ``every``-th event is lost."""
    return labels(spark, sf_dir).where(F.col("event_id") % every != at)


def scores_of_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score table that was only kept for attacks."""
    return scored(spark, sf_dir).where(F.col("label") != rules.NORMAL)


def scores_before_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score table that was written before the test part came in."""
    return scored(spark, sf_dir).where(F.col("split") != "test")


def attack_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with attacks of full strength added, derived from its events: bursts of 60 failed logins on one entity, 25
    entities tried from one address, six unusual resources in an hour, and nightly reads of secrets on many days."""
    log = access_log(spark, sf_dir)
    number = F.substring("entity_id", 5, 5).cast("int")
    failed = {"session_duration": F.lit(0).cast("long"), "auth_method": F.lit("password")}

    def added(rows: DataFrame, kind: int, n: int, window_s: int, **columns) -> DataFrame:
        each = rows.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
        start = F.col("ts_us") - F.col("ts_us") % (window_s * 1_000_000)
        each = each.withColumn("ts_us", start + F.col("i") * 1_000_000).withColumns(columns)
        return each.withColumn("event_id", F.col("event_id") * 1000 + kind * 100 + F.col("i") + 10**12).select(*log.columns)

    burst = added(log.where((F.col("label") == "brute_force") & (F.col("event_id") % 50 == 0)), 1, 60, 600, **failed)
    stuffing = added(
        log.where(F.col("event_id") % 200 == 0), 2, 25, 1800, **failed,
        entity_id=F.concat(F.lit("TRY_"), F.lpad(((F.col("event_id") + F.col("i") * 7) % 90000).cast("string"), 5, "0")),
        source_ip=F.concat(F.lit("198.51.100."), (F.col("event_id") % 200).cast("string")),
    )
    lateral = added(
        log.where(F.col("event_id") % 300 == 1), 3, 6, 3600, resource_accessed=F.concat(F.lit("vm_"), F.col("i").cast("string"))
    )
    night = START_US + (F.col("event_id") % 30) * 86_400_000_000 + 7_200_000_000
    exfil = log.where(number % 40 == 3).withColumns(
        {"ts_us": night, "resource_accessed": F.lit("/vault/secrets/api_keys"), "event_id": F.col("event_id") * 1000 + 400 + 10**12}
    )
    return log.unionByName(burst).unionByName(stuffing).unionByName(lateral).unionByName(exfil.select(*log.columns))


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in its source form: ISO text, JSON texts, text ids."""
    log = access_log(spark, sf_dir)
    return log.select(
        F.col("event_id").cast("string").alias("event_id"),
        "entity_id",
        "entity_type",
        iso_text(F.col("ts_us")).alias("timestamp"),
        "source_ip",
        F.to_json(F.struct("lat", "lon", F.lit("US").alias("country"))).alias("geo_location"),
        "resource_accessed",
        "auth_method",
        "session_duration",
        "bytes_transferred",
        F.when(F.col("event_id") % 5 == 0, F.to_json(F.array(F.lit("sudo su"), F.col("resource_accessed")))).alias(
            "command_sequence"
        ),
        F.to_json(
            F.struct("os", F.lit("v1.0").alias("firmware"), "mac", F.lit("HTTPS").alias("protocol"))
        ).alias("device_fingerprint"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = access_log(spark, sf_dir)
    return log.select("event_id", "label", F.lit(None).cast("string").alias("attack_scenario_id"))


_tables: dict[tuple, object] = {}


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size and time of the last change of an input, so that rewritten input is not mistaken for what was read before."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength(), files.getFileStatus(place).getModificationTime()


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """What an earlier phase wrote for later ones: built on first use in a session, then read back."""
    key = (spark.sparkContext.applicationId, sf_dir, version(spark, f"{sf_dir}/events.parquet"), name)
    if key not in _tables:
        _tables[key] = build()
    return _tables[key]


def learned(spark: SparkSession, sf_dir: str) -> chain.Learned:
    """Split constants and profile tables of the training phase."""
    return shared(spark, sf_dir, "learned", lambda: chain.learn(access_log(spark, sf_dir)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and ensemble scores of every event and its trailing features: one written table, and what follows from its rows."""
    return shared(spark, sf_dir, "scored", lambda: chain.ensemble_scores(learned(spark, sf_dir), with_trailing=True))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined feature matrix with scores, on the table of the scores."""
    return chain.combined_features(learned(spark, sf_dir), scored(spark, sf_dir))


def event_store(spark: SparkSession, sf_dir: str) -> str:
    """Where the log lies by day and entity."""

    def build() -> str:
        path = scratch_dir(spark)
        stores.write_events(access_log(spark, sf_dir), path)
        return path

    return shared(spark, sf_dir, "event_store", build)


def queue_store(spark: SparkSession, sf_dir: str) -> str:
    """Where the alerts lie in ranges of the queue's order."""

    def build() -> str:
        path = scratch_dir(spark)
        stores.write_queue(alerts(spark, sf_dir), path, range_rows=100)
        return path

    return shared(spark, sf_dir, "queue_store", build)


def signals() -> tuple:
    return tuple(F.col(c) for c in ("geo_velocity_kmh", "geo_distance_prev_km", "failed_auth_count_5min"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged events with the class the classifier learns."""
    rows = features(spark, sf_dir).where(scoring.is_flagged())
    return rows.withColumn("target_class", rules.target_class(F.col("label")))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged events with risk score and out-of-fold prediction: the rule's class where one fired, else the classifier's."""
    predicted = shared(spark, sf_dir, "predictions", lambda: written(models.cv_oof(flagged(spark, sf_dir), chain.FEATURES)))
    return predicted.withColumn("risk_score", F.round("score_ensemble", 6))


MODEL_VERDICT, WRONG_VERDICT = "(model)", "(wrong)"


def checkable(rows: DataFrame, alerts: DataFrame, column: str = "predicted_attack_type") -> DataFrame:
    """``rows`` with verdicts of the classifier replaced by one mark, so that the rest can be checked by SQL.

    The mark is only given where ``rows`` holds what the classifier said of that event, which has to be a known class
    with a confidence in (0, 1]; what a rule said stays.
    """
    said = alerts.select(
        F.col("event_id").cast("string").alias("said_of"), F.col("predicted_attack_type").alias("said"),
        F.col("confidence").alias("said_surely"), F.col("prediction_source").alias("said_by"),
    )
    classes = [c for c in (*rules.CLASSES, rules.UNKNOWN) if c != rules.NORMAL]
    good = (F.col(column) == F.col("said")) & F.col(column).isin(*classes) & (F.col("said_surely") > 0) & (F.col("said_surely") <= 1)
    kept = [c for c in rows.columns if c != column]
    by_rule = F.col("said_by") != rules.MODEL_TEXT
    joined = rows.join(said, F.col("event_id").cast("string") == F.col("said_of"), "left")
    verdict = F.when(by_rule & (F.col(column) == F.col("said")), F.col(column)).when(~by_rule & good, F.lit(MODEL_VERDICT))
    return joined.select(*kept, F.coalesce(verdict, F.lit(WRONG_VERDICT)).alias(column))
