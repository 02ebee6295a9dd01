"""Named SQL steps for the check queries, written in the plainest form an ANSI engine takes.

``sql(body)`` puts the steps that ``body`` mentions in front of it. The SQL computes every window
and rank directly, on purpose unlike the Spark plans.
"""

from __future__ import annotations

import re

from logvigil.plans.derived import START_US


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(6371.0e0 * 2 * atan2(sqrt({a}), sqrt(greatest(0.0e0, 1 - {a}))))"


def r4(*names: str) -> str:
    """``expr AS x`` rounded to four places for each name, with the nudge of the registry."""
    out = []
    for name in names:
        expr, _, alias = name.rpartition(" AS ")
        out.append(f"round({expr or name} + 1e-9, 4) AS {alias}")
    return ", ".join(out)


VELOCITY = "coalesce(CASE WHEN sec > p_sec THEN km / ((sec - p_sec) / 3600.0e0) END, 0.0e0)"
SURPRISE = ("resource", "auth", "os")

STEPS: dict[str, str] = {
    "ev": """SELECT event_id e, user_id u, event_type et, value v, cast(json_extract_string(props, '$.k') AS bigint) k,
      epoch_us(ts) - 1704067200000000 AS off FROM events""",
    "ec": "SELECT *, CASE WHEN u % 25 = 0 THEN (u % 30) * 86400000000 + off // 8640 ELSE off END AS tus FROM ev",
    "a0": f"""SELECT e AS event_id,
      concat(CASE WHEN u % 20 < 14 THEN 'USR_' WHEN u % 20 < 17 THEN 'SRV_' ELSE 'DEV_' END, lpad(cast(u AS varchar), 5, '0')) AS entity_id,
      CASE WHEN u % 20 < 14 THEN 'user' WHEN u % 20 < 17 THEN 'service_account' ELSE 'edge_device' END AS entity_type,
      {START_US} + tus AS ts_us,
      CASE WHEN e % 23 = 0 THEN concat('203.0.113.', cast(e % 200 AS varchar))
           ELSE concat('10.', cast(u % 256 AS varchar), '.0.', cast(e % 3 AS varchar)) END AS source_ip,
      cast((u * 37) % 140 - 70 AS double) + cast((e * 13) % 100 - 50 AS double) / 1000.0e0
        + CASE WHEN e % 23 = 0 THEN 15.0e0 ELSE 0.0e0 END AS lat,
      cast(((u * 91) % 360 + CASE WHEN e % 23 = 0 THEN 25 ELSE 0 END) % 360 - 180 AS double) AS lon,
      concat('res_', lpad(cast(CASE WHEN k < 70 THEN (u + k % 5) % 12 ELSE (u * 7 + k) % 12 END AS varchar), 2, '0')) AS resource_accessed,
      CASE et WHEN 'click' THEN 'password' WHEN 'error' THEN 'password' WHEN 'view' THEN 'token'
              WHEN 'signup' THEN 'certificate' ELSE 'biometric' END AS auth_method,
      CASE WHEN et = 'error' THEN 0 ELSE cast(floor(v * 10) AS bigint) END AS session_duration,
      cast(floor(v * 1000) AS bigint) + 100 AS bytes_transferred,
      CASE WHEN e % 101 = 0 THEN concat('mac_new_', cast(e AS varchar)) ELSE concat('mac_', cast(u AS varchar), '_', cast(e % 2 AS varchar)) END AS mac,
      CASE WHEN e % 101 = 0 THEN 'os_x' ELSE concat('os_', cast(u % 6 AS varchar)) END AS os,
      CASE WHEN u % 25 = 0 THEN 'brute_force' WHEN e % 23 = 0 THEN 'impossible_travel'
           WHEN e % 101 = 0 THEN 'device_spoofing' ELSE 'normal' END AS label
      FROM ec""",
    "al": """SELECT *, ts_us // 1000000 AS sec, (ts_us % 86400000000) // 60000000 AS md,
      ((ts_us % 86400000000) // 60000000) // 60 + (((ts_us % 86400000000) // 60000000) % 60) / 60.0e0 AS hod,
      CASE WHEN session_duration = 0 OR auth_method = 'password' THEN 1 ELSE 0 END AS failed FROM a0""",
    # the log with attacks added: kind, rows and start of the added rows as in derived.attack_log
    "ak": """SELECT event_id, entity_id, ts_us, source_ip, resource_accessed, auth_method, session_duration, bytes_transferred FROM al
      UNION ALL SELECT event_id * 1000 + 100 + i + 1000000000000, entity_id, ts_us // 600000000 * 600000000 + i * 1000000, source_ip,
        resource_accessed, 'password', 0, bytes_transferred FROM al, range(60) r(i) WHERE label = 'brute_force' AND event_id % 50 = 0
      UNION ALL SELECT event_id * 1000 + 200 + i + 1000000000000, concat('TRY_', lpad(cast((event_id + i * 7) % 90000 AS varchar), 5, '0')),
        ts_us // 1800000000 * 1800000000 + i * 1000000, concat('198.51.100.', cast(event_id % 200 AS varchar)), resource_accessed, 'password', 0,
        bytes_transferred FROM al, range(25) r(i) WHERE event_id % 200 = 0
      UNION ALL SELECT event_id * 1000 + 300 + i + 1000000000000, entity_id, ts_us // 3600000000 * 3600000000 + i * 1000000, source_ip,
        concat('vm_', cast(i AS varchar)), auth_method, session_duration, bytes_transferred FROM al, range(6) r(i) WHERE event_id % 300 = 1
      UNION ALL SELECT event_id * 1000 + 400 + 1000000000000, entity_id, 1704067200000000 + (event_id % 30) * 86400000000 + 7200000000, source_ip,
        '/vault/secrets/api_keys', auth_method, session_duration, bytes_transferred FROM al WHERE cast(substr(entity_id, 5, 5) AS integer) % 40 = 3""",
    "nk": """SELECT a.event_id, a.entity_id, count(DISTINCT CASE WHEN tr.entity_id IS NULL THEN b.resource_accessed END) AS new_resource_count_1h
      FROM ak a JOIN ak b ON a.entity_id = b.entity_id AND b.ts_us // 1000000 >= a.ts_us // 1000000 - 3600
        AND (b.ts_us < a.ts_us OR (b.ts_us = a.ts_us AND b.event_id <= a.event_id))
      LEFT JOIN tr ON tr.entity_id = b.entity_id AND tr.resource_accessed = b.resource_accessed GROUP BY a.event_id, a.entity_id""",
    "sp": """SELECT *, CASE WHEN rn <= floor(0.70e0 * n) THEN 'train' WHEN rn <= floor(0.85e0 * n) THEN 'val' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (ORDER BY ts_us, event_id) AS rn, count(*) OVER () AS n FROM al)""",
    "tn": "SELECT * FROM sp WHERE split = 'train' AND label = 'normal'",
    "pb": """SELECT entity_id, count(*) AS num_events, avg(lat) AS home_lat, avg(lon) AS home_lon,
      avg(session_duration) AS duration_mean,
      CASE WHEN count(*) > 1 THEN stddev_pop(session_duration) ELSE 10.0e0 END AS duration_std,
      stddev_samp(hod) AS hour_std, var_pop(hod) AS hour_var, max(ts_us) AS last_ts_us FROM tn GROUP BY entity_id""",
    "pr": f"""SELECT entity_id, avg({hav('home_lat', 'home_lon', 'lat', 'lon')}) AS avg_radius
      FROM tn JOIN pb USING (entity_id) GROUP BY entity_id""",
    "tr": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, resource_accessed) AS rank
      FROM (SELECT entity_id, resource_accessed, count(*) AS n FROM tn GROUP BY ALL)) WHERE rank <= 5""",
    "pw": "SELECT * FROM pb WHERE num_events >= 5",
    "gp": """SELECT count(*) AS num_events, avg(lat) AS home_lat, avg(lon) AS home_lon, avg(session_duration) AS duration_mean,
      stddev_pop(session_duration) AS duration_std, stddev_samp(hod) AS hour_std, var_pop(hod) AS hour_var FROM tn""",
    "gr": "SELECT resource_accessed, count(*) AS n FROM tn GROUP BY resource_accessed ORDER BY n DESC, resource_accessed LIMIT 10",
    "ed": "SELECT DISTINCT entity_id, mac FROM tn WHERE mac <> ''",
    "gd": "SELECT DISTINCT mac FROM tn WHERE mac <> ''",
    "lk": """SELECT s.*, p.entity_id IS NULL AS cold, CASE WHEN p.entity_id IS NULL THEN '' ELSE s.entity_id END AS owner,
      coalesce(p.home_lat, g.home_lat) AS p_lat, coalesce(p.home_lon, g.home_lon) AS p_lon,
      coalesce(p.duration_mean, g.duration_mean) AS p_mean, coalesce(p.duration_std, g.duration_std) AS p_std, p.last_ts_us
      FROM sp s LEFT JOIN pw p USING (entity_id) CROSS JOIN gp g""",
    "bf": f"""SELECT l.*, hod AS hour_of_day, (l.ts_us // 86400000000 + 3) % 7 AS day_of_week,
      CASE WHEN (l.ts_us // 86400000000 + 3) % 7 >= 5 THEN 1 ELSE 0 END AS is_weekend,
      (session_duration - p_mean) / (p_std + 1e-5) AS norm_session_duration,
      {hav('p_lat', 'p_lon', 'lat', 'lon')} AS geo_distance_from_centroid_km,
      CASE WHEN (cold AND gr.resource_accessed IS NULL) OR (NOT cold AND tr.entity_id IS NULL) THEN 1 ELSE 0 END AS resource_novelty,
      CASE WHEN (cold AND gd.mac IS NULL) OR (NOT cold AND ed.entity_id IS NULL) THEN 1 ELSE 0 END AS device_fingerprint_hash_novelty,
      CASE WHEN auth_method = 'password' THEN 1 ELSE 0 END AS auth_password,
      CASE WHEN auth_method = 'token' THEN 1 ELSE 0 END AS auth_token,
      CASE WHEN auth_method = 'certificate' THEN 1 ELSE 0 END AS auth_certificate,
      CASE WHEN auth_method = 'biometric' THEN 1 ELSE 0 END AS auth_biometric,
      CASE WHEN cold THEN 1 ELSE 0 END AS cold_start, CASE WHEN cold THEN 1.0e0 ELSE 0.0e0 END AS is_cold_start,
      CASE WHEN cold THEN 1.0e0 ELSE exp(-ln(2.0e0) / 7 * greatest(0.0e0, (sec - last_ts_us / 1e6) / 86400.0e0)) END AS profile_decay_factor
      FROM lk l LEFT JOIN tr ON tr.entity_id = l.entity_id AND tr.resource_accessed = l.resource_accessed
      LEFT JOIN gr ON gr.resource_accessed = l.resource_accessed
      LEFT JOIN ed ON ed.entity_id = l.entity_id AND ed.mac = l.mac LEFT JOIN gd ON gd.mac = l.mac""",
    "eh": """SELECT entity_id AS owner, md, count(*) AS n FROM tn GROUP BY ALL
      UNION ALL SELECT '' AS owner, md, count(*) AS n FROM tn GROUP BY md""",
    "ow": """SELECT entity_id AS owner, num_events, hour_std FROM pw WHERE hour_var >= 1e-4
      UNION ALL SELECT '', num_events, hour_std FROM gp WHERE hour_var > 0""",
    "dn": """SELECT q.owner, q.md, sum(h.n * exp(-0.5e0 * pow((q.md - h.md) / 60.0e0 / (0.2e0 * hour_std), 2)))
        / (any_value(num_events) * 0.2e0 * any_value(hour_std) * sqrt(2 * pi())) AS density
      FROM (SELECT DISTINCT owner, md FROM lk) q JOIN ow USING (owner) JOIN eh h ON h.owner = q.owner GROUP BY q.owner, q.md""",
    "bs": """SELECT bf.*, density, (least(1.0e0, geo_distance_from_centroid_km / 150) + (1 - exp(-abs(norm_session_duration) / 2))
        + CASE WHEN density IS NULL THEN 0.5e0 ELSE greatest(0.0e0, least(1.0e0, 1 - density / 0.25e0)) END
        + 2.5e0 * resource_novelty + 2.5e0 * device_fingerprint_hash_novelty) / 8 AS score
      FROM bf LEFT JOIN dn ON dn.owner = bf.owner AND dn.md = bf.md""",
    "lg": """SELECT *, lag(lat) OVER w AS p_lat0, lag(lon) OVER w AS p_lon0, lag(sec) OVER w AS p_sec, lag(label) OVER w AS p_label,
      lag(ts_us) OVER w AS p_ts FROM al WINDOW w AS (PARTITION BY entity_id ORDER BY ts_us, event_id)""",
    "gv": f"""SELECT *, coalesce({hav('p_lat0', 'p_lon0', 'lat', 'lon')}, 0.0e0) AS km FROM lg""",
    "fa": """SELECT event_id, cast(sum(failed) OVER (PARTITION BY entity_id ORDER BY sec RANGE BETWEEN 300 PRECEDING AND CURRENT ROW)
      - coalesce(sum(failed) OVER (PARTITION BY entity_id, sec ORDER BY ts_us, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)
      AS bigint) AS failed_auth_count_5min FROM al""",
    "hr": """SELECT a.event_id, b.source_ip, b.resource_accessed, b.entity_id FROM al a JOIN al b ON a.entity_id = b.entity_id
      AND b.sec >= a.sec - 3600 AND (b.ts_us < a.ts_us OR (b.ts_us = a.ts_us AND b.event_id <= a.event_id))""",
    "di": "SELECT event_id, count(DISTINCT source_ip) AS distinct_ip_count_1h FROM hr GROUP BY event_id",
    "nr": """SELECT hr.event_id, count(DISTINCT CASE WHEN tr.entity_id IS NULL THEN hr.resource_accessed END) AS new_resource_count_1h
      FROM hr LEFT JOIN tr ON tr.entity_id = hr.entity_id AND tr.resource_accessed = hr.resource_accessed GROUP BY hr.event_id""",
    "wf": f"""SELECT gv.event_id, failed_auth_count_5min, distinct_ip_count_1h, new_resource_count_1h,
      {VELOCITY} AS geo_velocity_kmh, km AS geo_distance_prev_km
      FROM gv JOIN fa USING (event_id) JOIN di USING (event_id) JOIN nr USING (event_id)""",
    "ce": "SELECT entity_id, avg(lat) AS c_lat, avg(lon) AS c_lon FROM sp WHERE split = 'train' GROUP BY entity_id",
    "cg": "SELECT avg(lat) AS g_lat, avg(lon) AS g_lon FROM sp WHERE split = 'train'",
    "cl": f"""SELECT s.*, coalesce(c_lat, g_lat) AS ce_lat, coalesce(c_lon, g_lon) AS ce_lon,
      {hav('coalesce(c_lat, g_lat)', 'coalesce(c_lon, g_lon)', 'lat', 'lon')} AS geo_distance
      FROM sp s LEFT JOIN ce USING (entity_id) CROSS JOIN cg""",
    "sc": """SELECT mean_dur, CASE WHEN std_dur > 1e-4 THEN std_dur ELSE 1.0e0 END AS std_dur, mean_dist,
      CASE WHEN std_dist > 1e-4 THEN std_dist ELSE 1.0e0 END AS std_dist FROM (
      SELECT avg(session_duration) AS mean_dur, stddev_samp(session_duration) AS std_dur, avg(geo_distance) AS mean_dist,
      stddev_samp(geo_distance) AS std_dist FROM cl WHERE split = 'train' AND label = 'normal')""",
    "sx": """SELECT cl.*, (session_duration - mean_dur) / std_dur AS x_duration, (geo_distance - mean_dist) / std_dist AS x_geo_dist,
      sin(2 * pi() * eh0 / 24) AS x_hour_sin, cos(2 * pi() * eh0 / 24) AS x_hour_cos,
      resource_accessed AS cur_resource, auth_method AS cur_auth, os AS cur_os,
      coalesce(lag(resource_accessed) OVER w, '<PAD>') AS prev_resource, coalesce(lag(auth_method) OVER w, '<PAD>') AS prev_auth,
      coalesce(lag(os) OVER w, '<PAD>') AS prev_os
      FROM (SELECT *, (sec % 86400) // 3600 + ((sec % 3600) // 60) / 60.0e0 + (sec % 60) / 3600.0e0 AS eh0 FROM cl) cl CROSS JOIN sc
      WINDOW w AS (PARTITION BY entity_id ORDER BY ts_us, event_id)""",
    "tc": " UNION ALL ".join(
        f"SELECT '{n}' AS feature, prev_{n} AS prev, cur_{n} AS cur, count(*) AS c FROM sx WHERE split = 'train' GROUP BY ALL"
        for n in SURPRISE
    ),
    "tv": "SELECT feature, count(DISTINCT cur) + 2 AS v FROM tc GROUP BY feature",
    "tp": "SELECT feature, prev, sum(c) AS n FROM tc GROUP BY ALL",
    "er": "SELECT sx.*, "
    + ", ".join(
        f"pow(x_{n} - coalesce(avg(x_{n}) OVER w, 0.0e0), 2) AS rec_err_{n}" for n in ("duration", "hour_sin", "hour_cos", "geo_dist")
    )
    + ", "
    + ", ".join(
        f"-ln((coalesce(c{i}.c, 0) + 1.0e0) / (coalesce(p{i}.n, 0) + (SELECT v FROM tv WHERE feature = '{n}'))) AS rec_err_{n}"
        for i, n in enumerate(SURPRISE)
    )
    + " FROM sx "
    + " ".join(
        f"LEFT JOIN tc c{i} ON c{i}.feature = '{n}' AND c{i}.prev = prev_{n} AND c{i}.cur = cur_{n}"
        f" LEFT JOIN tp p{i} ON p{i}.feature = '{n}' AND p{i}.prev = prev_{n}"
        for i, n in enumerate(SURPRISE)
    )
    + " WINDOW w AS (PARTITION BY entity_id ORDER BY ts_us, event_id ROWS BETWEEN 31 PRECEDING AND 1 PRECEDING)",
    "et": """SELECT *, rec_err_duration + rec_err_hour_sin + rec_err_hour_cos + rec_err_geo_dist + rec_err_resource + rec_err_auth
      + rec_err_os AS seq_error FROM er""",
    "e0": """SELECT bs.*, rec_err_duration, rec_err_hour_sin, rec_err_hour_cos, rec_err_geo_dist, rec_err_resource, rec_err_auth,
      rec_err_os, seq_error FROM bs JOIN et USING (event_id)""",
    "er2": """SELECT min(seq_error) FILTER (split = 'val') AS sl, max(seq_error) FILTER (split = 'val') AS sh,
      min(score) AS bl, max(score) AS bh FROM e0""",
    "e1": """SELECT *, 0.5e0 * score_seq + 0.5e0 * score_base AS score_ensemble FROM (SELECT e0.*,
      greatest(0.0e0, least(1.0e0, (seq_error - sl) / CASE WHEN abs(sh - sl) < 1e-8 THEN 1.0e0 ELSE sh - sl END)) AS score_seq,
      (score - bl) / (bh - bl + 1e-8) AS score_base FROM e0 CROSS JOIN er2)""",
    "th": "SELECT quantile_cont(score_ensemble, 0.99) AS threshold FROM e1 WHERE split = 'val' AND label = 'normal'",
    "en": "SELECT e1.*, threshold, score_ensemble >= threshold AS is_anomaly FROM e1 CROSS JOIN th",
    "cf": """SELECT en.*, failed_auth_count_5min, distinct_ip_count_1h, new_resource_count_1h, geo_velocity_kmh, geo_distance_prev_km
      FROM en JOIN wf USING (event_id)""",
    "rl": """SELECT *, CASE WHEN geo_velocity_kmh > 900 AND geo_distance_prev_km > 500 THEN 'impossible_travel'
      WHEN failed_auth_count_5min > 30 THEN 'brute_force' END AS rule FROM cf""",
    # Only flagged rows are alerts. What the classifier says has no SQL; '(model)' stands for any verdict of it that is in order.
    "ra": """SELECT *, round(score_ensemble, 6) AS risk_score, coalesce(rule, '(model)') AS predicted_attack_type FROM rl
      WHERE is_anomaly OR score_ensemble >= threshold""",
}
_NAMES = re.compile(r"\b[a-z][a-z0-9]{1,3}\b")


def _needed(text: str, found: dict[str, None]) -> None:
    for name in _NAMES.findall(re.sub(r"'[^']*'", "", text)):
        if name in STEPS and name not in found and re.search(rf"(FROM|JOIN|\()\s*{name}\b|CROSS JOIN {name}\b", text):
            _needed(STEPS[name], found)
            found[name] = None


def sql(body: str) -> str:
    """``body`` with the steps it reads, each written once, in order."""
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({STEPS[n]})" for n in found) + "\n" + body
