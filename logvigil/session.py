"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: With it rows that lie by one column are joined by that column and others where they are, as no other exchange is asked for.
JOIN_IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: What a task sorts of whole events, about: 100 MB or so for each order it needs them in, and packed a part of what a shuffle holds for it.
ROWS_A_TASK, PACKED_A_TASK = 100_000, "16m"
#: What a task reads of the log and deals out, some 140 MB. Left alone a scan follows packed bytes, of which 128 MB hold millions of events.
ROWS_A_SCAN = 500_000

_local_scratch: dict[str, str] = {}


def local_session(app: str = "logvigil", cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings.

    The two small sizes let tables of a few megabytes use all cores.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own: on a
    cluster a machine-local folder would be lost with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="logvigil-")
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/logvigil-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all that this application wrote below the shared folder. Call it when no result is read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for a stretch of work; afterwards they are what they were."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def sized_tasks(spark: SparkSession, rows: int) -> dict[str, str]:
    """Settings that deal ``rows`` events over enough tasks for each to sort its own in memory, so that none spills however many there are.

    A larger number of partitions that is set already stays. Small ones are still put together, but not to more than a task's share.
    A table written with :func:`sized_files` is also read by enough tasks.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_A_TASK))
    scans = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    scans = max(int(scans or spark.sparkContext.defaultParallelism), math.ceil(rows / ROWS_A_SCAN))
    return {
        "spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.advisoryPartitionSizeInBytes": PACKED_A_TASK,
        "spark.sql.files.minPartitionNum": str(scans),
    }


def sized_files() -> dict[str, str]:
    """Settings that write files of at most the events that a task is to read, as a file of one row group goes to one task."""
    return {"spark.sql.files.maxRecordsPerFile": str(ROWS_A_SCAN)}


def written(df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """Cut lineage: write the rows to the shared folder once and read them from there.

    Unlike cached blocks the table survives lost executors, and its size is known to the planner. Spark drops the
    shuffles of the write when it has ended, so that a job of several phases does not hold those of all of them.
    ``settings`` hold during the write only.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    with held(spark, {DROP_SHUFFLES: "true"} | (settings or {})):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
