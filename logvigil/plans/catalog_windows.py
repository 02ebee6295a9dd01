"""Windows over entity timelines and the whole stream, sorts, samples, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from logvigil.functions.clock import US_PER_HOUR, US_PER_SECOND
from logvigil.operators import attribution, audit, profiles, ranks, sampling, scoring, sequence, timeline, trailing, triage
from logvigil.plans import derived, verdicts
from logvigil.plans.catalog_columns import VOCAB
from logvigil.plans.oracle import VELOCITY, r4
from logvigil.plans.registry import query
from logvigil.sources import stores


@query("geo_velocity", f"SELECT event_id, {r4('km AS geo_distance_prev_km', VELOCITY + ' AS geo_velocity_kmh')} FROM gv")
def geo_velocity(spark, sf):
    rows = trailing.geo_velocity(derived.access_log(spark, sf))
    return rows.select("event_id", "geo_distance_prev_km", "geo_velocity_kmh")


@query("failed_auth_count_5min", "SELECT event_id, failed_auth_count_5min FROM fa")
def failed_auth_count(spark, sf):
    rows = trailing.trailing_features(derived.access_log(spark, sf), addresses=False, travel=False)
    return rows.select("event_id", "failed_auth_count_5min")


@query("distinct_ip_count_1h", "SELECT event_id, distinct_ip_count_1h FROM di")
def distinct_ip_count(spark, sf):
    rows = trailing.trailing_features(derived.access_log(spark, sf), failures=False, travel=False)
    return rows.select("event_id", "distinct_ip_count_1h")


@query("new_resource_count_1h", "SELECT event_id, new_resource_count_1h FROM nr")
def new_resource_count(spark, sf):
    typical = profiles.typical_pairs(derived.learned(spark, sf).profiles)
    rows = trailing.trailing_features(derived.access_log(spark, sf), typical, failures=False, addresses=False, travel=False)
    return rows.select("event_id", "new_resource_count_1h")


@query("sequence_windows", """SELECT event_id, entity_id, min(ts_us) OVER w AS start_us, ts_us AS end_us,
  cast(count(*) OVER w AS integer) AS event_count, array_to_string(list(event_id) OVER w, ',') AS log_ids FROM al
  WINDOW w AS (PARTITION BY entity_id ORDER BY ts_us, event_id ROWS BETWEEN 31 PRECEDING AND CURRENT ROW)""")
def sequence_windows(spark, sf):
    rows = sequence.sequence_windows(derived.access_log(spark, sf))
    return rows.withColumn("log_ids", F.array_join(F.col("log_ids").cast("array<string>"), ","))


@query("left_pad", f"""SELECT event_id, array_to_string(list_concat(list_resize([0], 32 - len(l), 0)[:32 - len(l)], l), ',') AS codes FROM (
  SELECT event_id, list(idx) OVER (PARTITION BY entity_id ORDER BY ts_us, event_id ROWS BETWEEN 31 PRECEDING AND CURRENT ROW) AS l
  FROM (SELECT al.*, coalesce(idx, 1) AS idx FROM al LEFT JOIN {VOCAB.format(c='resource_accessed')} ON value = resource_accessed))""")
def left_pad(spark, sf):
    split = derived.learned(spark, sf).events
    vocab = sequence.vocab_fit(split.where(F.col("split") == "train"), "resource_accessed")
    rows = sequence.vocab_encode(split, "resource_accessed", vocab, "idx").select("event_id", "entity_id", "ts_us", "idx")
    rows = timeline.with_context(timeline.with_width(rows), sequence.SEQ_LENGTH - 1)
    window = F.collect_list("idx").over(timeline.row_window(-(sequence.SEQ_LENGTH - 1), 0))
    rows = timeline.drop_context(rows.withColumn("window", window))
    codes = sequence.left_pad(F.col("window"))
    return rows.select("event_id", F.array_join(codes.cast("array<string>"), ",").alias("codes"))


def _rolling_sql(days: int) -> str:
    window = f"OVER (ORDER BY ts_us RANGE BETWEEN {days * 86_400_000_000 - 1} PRECEDING AND CURRENT ROW)"
    return f"""SELECT event_id, {days} AS days, round(greatest(0.0e0, least(1.0e0, (s - lo) / CASE WHEN hi = lo THEN 1.0e0 ELSE hi - lo END)) + 1e-9, 4)
      AS normalized_score FROM (SELECT event_id, score_ensemble AS s, min(score_ensemble) {window} AS lo, max(score_ensemble) {window} AS hi FROM e1)"""


@query("rolling_minmax", _rolling_sql(30) + " UNION ALL " + _rolling_sql(5))
def rolling_minmax(spark, sf):
    rows = derived.scored(spark, sf).select("event_id", "ts_us", "score_ensemble")
    out = None
    for days in (30, 5):
        part = scoring.rolling_minmax(rows, "score_ensemble", days=days)
        part = part.select("event_id", F.lit(days).alias("days"), "normalized_score")
        out = part if out is None else out.unionByName(part)
    return out


@query("chrono_split", "SELECT event_id, split FROM sp")
def chrono_split(spark, sf):
    return ranks.chrono_split(derived.access_log(spark, sf)).select("event_id", "split")


@query("entity_tail", """SELECT event_id, entity_id, cast(back AS integer) AS back FROM (SELECT *,
  row_number() OVER (PARTITION BY entity_id ORDER BY ts_us DESC, event_id DESC) AS back FROM al) WHERE back <= 5""")
def entity_tail(spark, sf):
    log = derived.access_log(spark, sf).select("event_id", "entity_id", "ts_us")
    return timeline.entity_tail(log, triage.HISTORY_EVENTS).select("event_id", "entity_id", "back")


@query("history_snippet", """SELECT event_id, array_to_string(list(concat_ws('|', event_id, strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ'),
  resource_accessed, source_ip, auth_method, session_duration)) OVER (PARTITION BY entity_id ORDER BY ts_us, event_id
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ';') AS history FROM al""")
def history_snippet(spark, sf):
    rows = attribution.history_snippet(derived.access_log(spark, sf))
    fields = ("event_id", "timestamp", "resource_accessed", "source_ip", "auth_method", "session_duration")
    lines = F.transform("history", lambda h: F.concat_ws("|", *[h[f].cast("string") for f in fields]))
    return rows.select("event_id", F.array_join(lines, ";").alias("history"))


def _last(n: int, table: str) -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY ts_us DESC, event_id DESC) AS back FROM {table}) WHERE back <= {n}"


@query("risk_timeline", f"SELECT entity_id, event_id, ts_us, {r4('risk_score')} FROM {_last(100, 'ra')}")
def risk_timeline(spark, sf):
    return triage.risk_timeline(derived.alerts(spark, sf))


@query("geo_trajectory", f"SELECT entity_id, event_id, ts_us, {r4('lat', 'lon')}, source_ip FROM {_last(20, 'al')}")
def geo_trajectory(spark, sf):
    return triage.geo_trajectory(derived.access_log(spark, sf))


FIRST_ENTITY = "(SELECT min(entity_id) FROM al)"


def first_entity_events(spark, sf):
    """Events of the first entity, out of the table laid out for such reads."""
    first = derived.access_log(spark, sf).agg(F.min("entity_id")).first()[0]
    return stores.stored_entity(spark, derived.event_store(spark, sf), first)


@query("entity_trajectory", f"SELECT entity_id, event_id, ts_us, {r4('lat', 'lon')}, source_ip FROM {_last(20, 'al')} AND entity_id = {FIRST_ENTITY}")
def entity_trajectory(spark, sf):
    return triage.geo_trajectory(first_entity_events(spark, sf))


@query("entity_hours", f"SELECT entity_id, cast(floor(hod) AS integer) AS hour, count(*) AS n FROM al WHERE entity_id = {FIRST_ENTITY} GROUP BY ALL")
def entity_hours(spark, sf):
    return triage.hour_histogram(first_entity_events(spark, sf))


@query("decay_timeline", f"SELECT entity_id, event_id, ts_us, {r4('profile_decay_factor')} FROM bf")
def decay_timeline(spark, sf):
    return triage.decay_timeline(derived.features(spark, sf))


COARSE = 6 * US_PER_HOUR


@query("monotonic_repair", f"""SELECT event_id, max(c - rn * 1000000) OVER (PARTITION BY entity_id ORDER BY c, event_id ROWS UNBOUNDED PRECEDING)
  + rn * 1000000 AS fixed_ts_us FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY c, event_id) AS rn FROM
  (SELECT event_id, entity_id, ts_us // {COARSE} * {COARSE} AS c FROM al))""")
def monotonic_repair(spark, sf):
    """Times cut to six hours collide, so there is something to repair."""
    log = derived.access_log(spark, sf).select("event_id", "entity_id", (F.col("ts_us") - F.col("ts_us") % COARSE).alias("ts_us"))
    return timeline.monotonic_repair(log, US_PER_SECOND).select("event_id", "fixed_ts_us")


@query("stratified_folds", """SELECT event_id, label, cast((row_number() OVER (PARTITION BY label ORDER BY
  md5(concat('42::', cast(event_id AS varchar))), event_id) - 1) % 5 AS integer)
  AS fold FROM al""")
def stratified_folds(spark, sf):
    return sampling.stratified_folds(derived.access_log(spark, sf).select("event_id", "label"), "label")


@query("sort_events", "SELECT entity_id, ts_us, event_id FROM al ORDER BY entity_id, ts_us, event_id")
def sort_events(spark, sf):
    return derived.access_log(spark, sf).select("entity_id", "ts_us", "event_id").orderBy("entity_id", "ts_us", "event_id")


def queue(alerts):
    return triage.alert_queue(alerts).select("event_id", "entity_id", "predicted_attack_type", "risk_score")


def masked_queue(spark, sf):
    alerts = derived.alerts(spark, sf)
    return queue(derived.checkable(alerts, alerts))


@verdicts.shown("alert_queue", f"SELECT event_id, entity_id, predicted_attack_type, {r4('risk_score')} FROM ra ORDER BY risk_score DESC, ts_us, event_id", masked_queue)
def alert_queue(spark, sf):
    return queue(derived.alerts(spark, sf))


@query("queue_page", f"SELECT event_id, {r4('risk_score')} FROM (SELECT * FROM ra ORDER BY risk_score DESC, ts_us, event_id LIMIT 25 OFFSET 25)")
def queue_page(spark, sf):
    return stores.stored_page(spark, derived.queue_store(spark, sf), 2, triage.PAGE_SIZE).select("event_id", "risk_score")


@query("queue_page_deep", f"""SELECT event_id, {r4('risk_score')} FROM (SELECT *, row_number() OVER (ORDER BY risk_score DESC, ts_us, event_id) - 1 AS place,
  count(*) OVER () AS alerts FROM ra) WHERE place >= (ceil(alerts / 25.0e0) - 1) * 25""")
def queue_page_deep(spark, sf):
    """The last page, which reads no more than the first."""
    store = derived.queue_store(spark, sf)
    last = stores.stored_pages(spark, store, triage.PAGE_SIZE)
    return stores.stored_page(spark, store, last, triage.PAGE_SIZE).select("event_id", "risk_score")


@query("queue_after", f"SELECT event_id, {r4('risk_score')} FROM (SELECT * FROM ra ORDER BY risk_score DESC, ts_us, event_id LIMIT 25 OFFSET 40)")
def queue_after(spark, sf):
    """The alerts that follow on the fortieth."""
    store = derived.queue_store(spark, sf)
    seen = stores.stored_page(spark, store, 2, 20).collect()
    if len(seen) < 20:
        return derived.alerts(spark, sf).select("event_id", "risk_score").limit(0)
    return stores.stored_after(spark, store, *[seen[-1][c] for c in stores.QUEUE_ORDER], triage.PAGE_SIZE).select("event_id", "risk_score")


@query("queue_page_count", "SELECT greatest(1, cast(ceil(count(*) / 25.0e0) AS bigint)) AS pages FROM ra")
def queue_page_count(spark, sf):
    return triage.page_count(derived.alerts(spark, sf))


@query("downsample_cap", "SELECT event_id, entity_id FROM al ORDER BY md5(concat('42::', cast(event_id AS varchar))), event_id LIMIT 2000")
def downsample_cap(spark, sf):
    return sampling.downsample_cap(derived.access_log(spark, sf).select("event_id", "entity_id"), cap=2000)


@query("sample_replace", """SELECT cast(i AS integer) AS draw, arg_min(event_id, (md5(concat('42:', i, ':', event_id)), event_id)) AS event_id,
  arg_min(entity_id, (md5(concat('42:', i, ':', event_id)), event_id)) AS entity_id FROM al CROSS JOIN range(15) r(i) GROUP BY i""")
def sample_replace(spark, sf):
    return sampling.sample_replace(derived.access_log(spark, sf).select("event_id", "entity_id"))


@query("concat_splits", "SELECT event_id, split, label FROM sp")
def concat_splits(spark, sf):
    split = derived.learned(spark, sf).events.select("event_id", "split", "label")
    parts = [split.where(F.col("split") == p) for p in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


CLASS_LIST = ", ".join(f"('{c}')" for c in (
    "normal", "brute_force", "credential_stuffing", "device_spoofing", "impossible_travel", "insider_drift",
    "lateral_movement", "low_slow_exfil"))


@query("set_difference", f"""SELECT 'class' AS kind, '' AS entity_id, c AS value FROM (VALUES {CLASS_LIST}) t(c) WHERE c NOT IN (SELECT label FROM al)
  UNION ALL SELECT 'resource', entity_id, resource_accessed FROM (SELECT DISTINCT entity_id, resource_accessed FROM al
  EXCEPT SELECT entity_id, resource_accessed FROM tr)""")
def set_difference(spark, sf):
    """Classes without a label; resources an entity used outside its usual ones."""
    log = derived.access_log(spark, sf)
    classes = audit.missing_classes(log).select(F.lit("class").alias("kind"), F.lit("").alias("entity_id"), F.col("label").alias("value"))
    typical = profiles.typical_pairs(derived.learned(spark, sf).profiles)
    used = log.select("entity_id", "resource_accessed").distinct()
    unusual = used.join(typical, ["entity_id", "resource_accessed"], "left_anti")
    return classes.unionByName(unusual.select(F.lit("resource").alias("kind"), "entity_id", F.col("resource_accessed").alias("value")))
