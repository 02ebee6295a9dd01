"""All registered queries, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.functions import rules
from logvigil.operators.trailing import trailing_features
from logvigil.plans import (  # noqa: F401
    catalog_aggregates,
    catalog_checks,
    catalog_columns,
    catalog_models,
    catalog_sources,
    catalog_streams,
    catalog_windows,
    derived,
)
from logvigil.plans.oracle import VELOCITY, r4
from logvigil.plans.registry import query


@query("rule_queue", f"""SELECT event_id, entity_id, ts_us, predicted_attack_type, failed_auth_count_5min, {r4('geo_velocity_kmh', 'km AS geo_distance_prev_km')}
  FROM (SELECT *, CASE WHEN geo_velocity_kmh > 900 AND km > 500 THEN 'impossible_travel' WHEN failed_auth_count_5min > 30 THEN 'brute_force' END
  AS predicted_attack_type FROM (SELECT gv.*, {VELOCITY} AS geo_velocity_kmh, failed_auth_count_5min FROM gv JOIN fa USING (event_id)))
  WHERE predicted_attack_type IS NOT NULL""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that trip a rule, fastest and most failures first."""
    rows = trailing_features(derived.access_log(spark, sf_dir), addresses=False)
    attack = rules.rule_class(*derived.signals())
    hits = rows.withColumn("predicted_attack_type", attack).where(F.col("predicted_attack_type").isNotNull())
    return hits.select(
        "event_id", "entity_id", "ts_us", "predicted_attack_type", "failed_auth_count_5min", "geo_velocity_kmh",
        "geo_distance_prev_km",
    ).orderBy(F.col("geo_velocity_kmh").desc(), F.col("failed_auth_count_5min").desc(), "ts_us", "event_id")
