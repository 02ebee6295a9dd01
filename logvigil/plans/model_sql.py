"""The two anomaly models in SQL: the same trees and directions from the same digests."""

from __future__ import annotations

from logvigil.operators import models
from logvigil.operators.profiles import BASE_FEATURES

N = len(BASE_FEATURES)
POINT = "[" + ", ".join(f"round(cast({f} AS double) + {models.NUDGE}, {models.DIGITS})" for f in BASE_FEATURES) + "]"
LIMIT = 8  # levels of a tree of 256 rows


def number(*parts: str, digits: int = 8) -> str:
    text = ", ':', ".join(parts)
    return f"CAST('0x' || substr(md5(concat({text})), 1, {digits}) AS BIGINT)"


def mean_path(n: str) -> str:
    return f"(CASE WHEN {n} <= 1 THEN 0e0 WHEN {n} = 2 THEN 1e0 ELSE 2e0 * (ln({n} - 1e0) + {models.EULER}) - 2e0 * ({n} - 1e0) / {n} END)"


PLACES = ", ".join(str(i) for i in range(1, N + 1))
POINTS = f"""points AS MATERIALIZED (SELECT event_id, label, split, {POINT} AS x FROM cf),
  normals AS MATERIALIZED (SELECT event_id, x FROM points WHERE split = 'train' AND label = 'normal')"""


def _forest() -> str:
    level = []
    for d in range(LIMIT + 1):
        node = f"""node{d} AS MATERIALIZED (SELECT *, CASE WHEN feature IS NOT NULL THEN
            low[feature] + {number("'42'", "t", "node", "'cut'")} / 4294967296e0 * (high[feature] - low[feature]) END AS cut
          FROM (SELECT *, CASE WHEN n > 1 AND len(vary) > 0 AND {d} < {LIMIT}
              THEN vary[1 + {number("'42'", "t", "node", "'feature'")} % len(vary)] END AS feature
            FROM (SELECT *, list_filter([{PLACES}], lambda i: high[i] > low[i]) AS vary FROM (
              SELECT t, node, count(*) AS n, [{', '.join(f'min(x[{i}])' for i in range(1, N + 1))}] AS low,
                [{', '.join(f'max(x[{i}])' for i in range(1, N + 1))}] AS high FROM rows{d} GROUP BY t, node))))"""
        down = f"2 * node + CASE WHEN x[feature] > cut THEN 2 ELSE 1 END AS node, x"
        more = f"""rows{d + 1} AS MATERIALIZED (SELECT t, {down} FROM rows{d} JOIN node{d} USING (t, node) WHERE feature IS NOT NULL),
          walk{d + 1} AS MATERIALIZED (SELECT event_id, t, {down} FROM walk{d} JOIN node{d} USING (t, node) WHERE feature IS NOT NULL)"""
        level += [node, more] if d < LIMIT else [node]
    ends = " UNION ALL ".join(
        f"SELECT event_id, {d} + {mean_path('n')} AS depth FROM walk{d} JOIN node{d} USING (t, node) WHERE feature IS NULL" for d in range(LIMIT + 1)
    )
    return f"""(WITH {POINTS},
      trees AS (SELECT t, 1 + {number("'42'", "t", "'factor'")} % {models.PRIME - 1} AS a, {number("'42'", "t", "'addend'")} % {models.PRIME} AS b
        FROM range({models.TREES}) r(t)),
      drawn AS (SELECT event_id, x, {number("'42'", "'row'", "event_id")} % {models.PRIME} AS own FROM normals),
      rows0 AS MATERIALIZED (SELECT t, 0 AS node, x FROM (SELECT t, x, row_number() OVER (PARTITION BY t ORDER BY (own * a + b) % {models.PRIME}, event_id)
        AS place FROM drawn CROSS JOIN trees) WHERE place <= {models.TREE_ROWS}),
      walk0 AS (SELECT event_id, t, 0 AS node, x FROM points CROSS JOIN trees),
      {', '.join(level)},
      scored AS (SELECT event_id, pow(2e0, -avg(depth) / (SELECT {mean_path('count(*)')} FROM rows0 WHERE t = 0)) AS iforest_score
        FROM ({ends}) GROUP BY event_id)
    SELECT event_id, label, split, iforest_score FROM scored JOIN points USING (event_id))"""


def _one_class(dims: int = 512) -> str:
    even = lambda *parts: f"(({number(*parts)} + 0.5e0) / 4294967296e0)"
    normal = f"""sqrt(-2e0 * ln({even("'42'", "i - 1", "d", "'radius'")})) * cos(2 * pi() * {even("'42'", "i - 1", "d", "'angle'")})"""
    mapped = f"sqrt(2e0 / {dims}) * cos(list_inner_product(z, w) + b)"
    return f"""(WITH {POINTS},
      spread AS (SELECT i, avg(x[i]) AS mean, stddev_pop(x[i]) AS std FROM normals CROSS JOIN range(1, {N + 1}) r(i) GROUP BY i),
      scale AS (SELECT list(mean ORDER BY i) AS mean, list(CASE WHEN std > 0 THEN std ELSE 1e0 END ORDER BY i) AS std,
        greatest(1, count(*) FILTER (std > 0)) AS varying FROM spread),
      basis AS MATERIALIZED (SELECT d, any_value(2 * pi() * {even("'42'", "d", "'shift'")}) AS b, list(sqrt(2e0 / varying) * {normal} ORDER BY i) AS w
        FROM range({dims}) r(d) CROSS JOIN range(1, {N + 1}) q(i) CROSS JOIN scale GROUP BY d),
      scaled AS MATERIALIZED (SELECT event_id, label, split, [(x[i] - mean[i]) / std[i] for i in [{PLACES}]] AS z FROM points CROSS JOIN scale),
      centre AS MATERIALIZED (SELECT d, avg({mapped}) AS c FROM scaled CROSS JOIN basis WHERE split = 'train' AND label = 'normal' GROUP BY d),
      scored AS (SELECT event_id, -sum({mapped} * c) AS one_class_score FROM scaled CROSS JOIN basis JOIN centre USING (d) GROUP BY event_id)
    SELECT event_id, label, split, one_class_score FROM scored JOIN points USING (event_id))"""


FOREST, ONE_CLASS = _forest(), _one_class()
