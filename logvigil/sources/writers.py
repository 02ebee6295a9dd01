"""Writers for scores, predictions, profiles, features, feedback and the live feed."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.functions.clock import iso_text
from logvigil.sources import schema


def write_table(
    df: DataFrame, path: str, columns: tuple[str, ...] = (), mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> None:
    """Write the columns (all by default) as parquet, optionally in folders, say one per day."""
    (df.select(*columns) if columns else df).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_predictions(df: DataFrame, path: str) -> None:
    rows = df.withColumn("timestamp", iso_text(F.col("ts_us"))) if "timestamp" not in df.columns else df
    write_table(rows, path, schema.PREDICTION_COLUMNS)


def table_exists(spark, path: str) -> bool:
    """True once a write to that path has been committed."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def _files(spark, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def input_version(spark, path: str) -> str:
    """A digest of the names, lengths and times of the files below ``path``: another one once any of them is rewritten."""
    files, place = _files(spark, path)
    listed, found = files.listFiles(place, True), []
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def cached_table(spark, path: str, compute: Callable[[], DataFrame], inputs: Sequence[str] = (), **parameters) -> DataFrame:
    """The table that ``compute`` gives for these inputs (paths) and parameters, computed and written on its first use.

    The key is made of the versions of the inputs and of the parameters, say the columns asked for: rewritten input gives a new table.
    A table is written to a folder of its own and published by renaming a small file that names it, so a reader sees a whole table or
    none, and of two writers one wins.
    """
    asked = [[input_version(spark, p) for p in inputs], sorted(parameters.items())]
    key = hashlib.sha256(json.dumps(asked, default=str).encode()).hexdigest()[:32]
    files, pointer = _files(spark, f"{path}/{key}.pointer")
    if not files.exists(pointer):
        folder = f"{path}/table-{uuid.uuid4().hex}"
        compute().write.parquet(folder)
        _, draft = _files(spark, f"{folder}.draft")
        stream = files.create(draft)
        stream.writeBytes(folder)
        stream.close()
        if not files.rename(draft, pointer) and not files.exists(pointer):
            raise OSError(f"cannot publish {pointer}")
    return spark.read.parquet(spark.read.text(f"{path}/{key}.pointer").first()[0])


def with_decision_id(decisions: DataFrame) -> DataFrame:
    """Decisions in the declared columns and types, with a digest that tells one from another."""
    rows = decisions.select(*[F.col(f.name).cast(f.dataType) for f in schema.FEEDBACK])
    named = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("")) for c in ("event_id", "timestamp", "analyst_action", "comments")])
    return rows.withColumn("decision_id", F.sha2(named.cast("binary"), 256))


def log_feedback(decisions: DataFrame, path: str) -> None:
    """Append analyst decisions that are not there yet: a write that is repeated adds nothing."""
    rows, spark = with_decision_id(decisions).dropDuplicates(["decision_id"]), decisions.sparkSession
    if table_exists(spark, path):
        rows = rows.join(spark.read.parquet(path).select("decision_id"), "decision_id", "left_anti")
    rows.select(*[f.name for f in schema.FEEDBACK], "decision_id").write.mode("append").parquet(path)


def live_rows(alerts: DataFrame) -> DataFrame:
    """Alerts in the columns and types of the live feed."""
    rows = alerts.withColumn("timestamp", iso_text(F.col("ts_us"))) if "timestamp" not in alerts.columns else alerts
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.LIVE_ALERT])


def write_live_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Write the feed in files of a fair size, however many pieces the alerts come in: a reader takes a few files at a time."""
    live_rows(alerts).hint("rebalance").write.mode(mode).json(path)
