"""Tables laid out for point reads: one event, one entity, one page of the queue.

* Events lie in folders by day and are sorted by entity inside, so a read of one entity touches the row groups that hold it, and a Parquet
  bloom filter on the event id keeps all other row groups of the day out of a read of one event. A small table of ids in hashed folders tells the
  day and the entity of an event, so that no other day is opened.
* The queue lies in ranges of its order, with the number of rows before each. A page reads the one or two ranges that hold it, and
  sorts these only, whatever its number is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from logvigil.functions.clock import US_PER_DAY

ID_FOLDERS = 64
EVENTS_A_FILE = 500_000  # about: what one task sorts
QUEUE_RANGE = 10_000  # alerts of a range, about
MOST_RANGES = 10_000
QUEUE_ORDER = ("risk_score", "ts_us", "event_id")


def day_of(ts_us: Column) -> Column:
    """Days since 1970."""
    return F.floor(ts_us / US_PER_DAY).cast("int")


def _folder(event_id: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(event_id.cast("string")), F.lit(folders)).cast("int")


def write_events(events: DataFrame, path: str, folders: int = ID_FOLDERS, file_rows: int = EVENTS_A_FILE, ids_a_row_group: int = 1_000_000) -> None:
    """Write ``events`` (event_id, entity_id, ts_us and more) and the table of their ids. The order decides where an event lies, so each
    file holds a stretch of entities of one day or a few, or of the events of one entity that fill more than a file in a day."""
    rows = events.withColumn("day", day_of(F.col("ts_us")))
    files = max(1, math.ceil(events.count() / file_rows))
    order = ("day", "entity_id", "ts_us", "event_id")
    laid = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    writer = laid.write.option("parquet.bloom.filter.enabled#event_id", "true")
    writer = writer.option("parquet.bloom.filter.expected.ndv#event_id", str(ids_a_row_group))
    writer.partitionBy("day").parquet(f"{path}/events")
    ids = rows.select("event_id", "entity_id", "day", _folder(F.col("event_id"), folders).alias("folder"))
    ids.repartition("folder").sortWithinPartitions("folder", "event_id").write.partitionBy("folder").parquet(f"{path}/ids")


def stored_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/events")


def event_places(spark: SparkSession, path: str, event_id, folders: int = ID_FOLDERS) -> list[Row]:
    """Day and entity of an event: one folder of ids is read."""
    ids = spark.read.parquet(f"{path}/ids")
    wanted = F.lit(event_id)
    return ids.where((F.col("folder") == _folder(wanted, folders)) & (F.col("event_id") == wanted)).select("day", "entity_id").distinct().collect()


def stored_event(spark: SparkSession, path: str, event_id, folders: int = ID_FOLDERS) -> DataFrame:
    """The rows of one event; an unknown id is an error. Of the events one day is read."""
    places = event_places(spark, path, event_id, folders)
    if not places:
        raise ValueError(f"no event with id {event_id}")
    days, entities = sorted({p["day"] for p in places}), sorted({p["entity_id"] for p in places})
    rows = stored_events(spark, path).where(F.col("day").isin(days) & F.col("entity_id").isin(entities) & (F.col("event_id") == event_id))
    return rows.drop("day")


def stored_entity(spark: SparkSession, path: str, entity_id: str, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
    """The events of one entity, of some days (both included) if given."""
    rows = stored_events(spark, path).where(F.col("entity_id") == entity_id)
    if first_day is not None:
        rows = rows.where(F.col("day") >= first_day)
    if last_day is not None:
        rows = rows.where(F.col("day") <= last_day)
    return rows.drop("day")


def _order() -> list[Column]:
    return [F.col("risk_score").desc(), F.col("ts_us").asc(), F.col("event_id").asc()]


def write_queue(alerts: DataFrame, path: str, range_rows: int = QUEUE_RANGE) -> None:
    """Write ``alerts`` in ranges of the queue's order, and where each range begins and ends."""
    spark = alerts.sparkSession
    ranges = max(1, min(MOST_RANGES, math.ceil(alerts.count() / range_rows)))
    dealt = alerts.repartitionByRange(ranges, *_order()).withColumn("range", F.spark_partition_id()).sortWithinPartitions(*_order())
    dealt.write.partitionBy("range").parquet(f"{path}/rows")
    rows = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
    key = F.struct((-F.col("risk_score")).alias("least"), "ts_us", "event_id")
    ends = rows.groupBy("range").agg(F.count("*").alias("n"), F.max(key).alias("last"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ends = ends.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).select("range", "n", "start", "last.*")
    ends.coalesce(1).write.parquet(f"{path}/ranges")


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ranges")


def stored_page(spark: SparkSession, path: str, page: int, size: int) -> DataFrame:
    """One page, counted from 1, in the queue's order. It reads the ranges that hold it."""
    first, end = (page - 1) * size, page * size
    held = _ranges(spark, path).where((F.col("start") < end) & (F.col("start") + F.col("n") > first)).select("range", "start").collect()  # size at most
    rows = spark.read.parquet(f"{path}/rows").where(F.col("range").isin([r["range"] for r in held])).drop("range")
    return rows.orderBy(*_order()).offset(first - min((r["start"] for r in held), default=first)).limit(size)


def stored_pages(spark: SparkSession, path: str, size: int) -> int:
    """Number of pages, one at least."""
    total = _ranges(spark, path).agg(F.sum("n")).first()[0] or 0
    return max(1, math.ceil(total / size))


def stored_after(spark: SparkSession, path: str, risk_score: float, ts_us: int, event_id, size: int) -> DataFrame:
    """The alerts that follow on a given one: pages that neither repeat nor skip rows while the queue is read."""
    key = (-F.lit(float(risk_score)), F.lit(ts_us), F.lit(event_id))

    def behind(columns: tuple[Column, Column, Column]) -> Column:
        risk, ts, event = columns
        return (risk > key[0]) | ((risk == key[0]) & ((ts > key[1]) | ((ts == key[1]) & (event > key[2]))))

    ends = _ranges(spark, path).where(behind((F.col("least"), F.col("ts_us"), F.col("event_id")))).orderBy("range").limit(size + 1).collect()
    wanted, rows = [], -ends[0]["n"] if ends else 0  # of the first range maybe all but one row lie before
    for end in ends:
        if rows >= size:
            break
        wanted.append(end["range"])
        rows += end["n"]
    found = spark.read.parquet(f"{path}/rows").where(F.col("range").isin(wanted) & behind((-F.col("risk_score"), F.col("ts_us"), F.col("event_id"))))
    return found.drop("range").orderBy(*_order()).limit(size)
