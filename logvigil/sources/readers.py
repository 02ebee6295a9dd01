"""Readers for logs, labels, scores and the live feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.functions.clock import parse_iso
from logvigil.sources import schema


def _read(spark: SparkSession, path: str, declared, fmt: str) -> DataFrame:
    reader = spark.read.schema(declared)
    if fmt == "csv":
        # JSON inside CSV: quotes are doubled. Records stay on one line, so files can be split
        return reader.option("header", True).option("escape", '"').csv(path)
    return reader.format(fmt).load(path)


def read_raw_logs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schema.ACCESS_LOG, fmt)


def read_labels(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schema.LABELS, fmt)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """The entity dimension from JSON lines."""
    return spark.read.schema(schema.ENTITY).json(path)


def json_field(text: str, declared, field: str, default) -> Column:
    """A field of a JSON text; bad text, NULL or a missing field gives the default."""
    return F.coalesce(F.from_json(F.col(text), declared)[field], F.lit(default))


def parse_json_fields(logs: DataFrame) -> DataFrame:
    """Replace the JSON texts by lat, lon, mac and os."""
    return logs.withColumns(
        {
            "lat": json_field("geo_location", schema.GEO, "lat", 0.0),
            "lon": json_field("geo_location", schema.GEO, "lon", 0.0),
            "mac": json_field("device_fingerprint", schema.DEVICE, "mac", ""),
            "os": json_field("device_fingerprint", schema.DEVICE, "os", ""),
        }
    ).drop("geo_location", "device_fingerprint")


def parse_commands(logs: DataFrame) -> DataFrame:
    return logs.withColumn("command_sequence", F.from_json("command_sequence", "array<string>"))


def load_access_logs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Typed access log: JSON fields parsed, ``ts_us`` from the ISO text."""
    logs = parse_commands(parse_json_fields(read_raw_logs(spark, path, fmt)))
    return logs.withColumn("ts_us", parse_iso(F.col("timestamp"))).drop("timestamp")


def join_labels(logs: DataFrame, labels: DataFrame, how: str = "inner") -> DataFrame:
    return logs.join(labels.select("event_id", "label"), "event_id", how)


def read_scores(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The named columns only; the others are never read."""
    return spark.read.parquet(path).select(*columns)


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """One row per decision, also if two writers appended it at the same time."""
    return spark.read.parquet(path).dropDuplicates(["decision_id"])


def read_live_alerts(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; blank and malformed lines are dropped."""
    return spark.read.schema(schema.LIVE_ALERT).options(mode="DROPMALFORMED", recursiveFileLookup=True).json(path)
