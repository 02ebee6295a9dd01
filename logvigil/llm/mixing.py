"""Mixing sources to target weights by Pfair scheduling.

Time is counted in blocks of documents. With share a of a period of T blocks, the j-th block of a
source is released at floor((j-1)T/a) and due at ceil(jT/a); running the released block with the
earliest deadline meets all deadlines, as the shares fill the period, and keeps each source less than
one block away from its target at any time. After T blocks all are exactly on target, so one period
(a small table) and arithmetic give the place of every block of the corpus.

When a source runs out, a new phase begins with the sources that are left, at the same shares of a
shorter period. No document is left out, and none is repeated.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logvigil.session import written

BLOCK_ROWS = 8  # documents of one block
BUCKET_ROWS = 2_000  # about as many documents of a source are ranked by one sort
PERIOD = 1000  # blocks of a period where shares are derived
MOST_SOURCES = 512  # the schedule has a tick table for each phase, and a phase ends with each source
COPIES = 1000  # of a row that repeats, listed together
MAX_PERIOD = 1_000_000  # shares are small whole numbers: the period is a table on the driver
SCHEMA_PHASES = "key string, phase int, first_block long, next_block long, phase_start long, share long, period long"
SCHEMA_TICKS = "key string, phase int, turn long, tick long"


def edf_period(shares: dict[str, int]) -> dict[str, list[int]]:
    """The ticks of one period that each source gets: earliest deadline first among released blocks."""
    period = sum(shares.values())
    if period > MAX_PERIOD:
        raise ValueError(f"the shares add up to {period}; take whole numbers that add up to {MAX_PERIOD} at most")
    waiting = [(0, key) for key in sorted(shares)]  # by release
    ready: list[tuple[int, str]] = []  # by deadline
    ticks: dict[str, list[int]] = {key: [] for key in shares}
    heapq.heapify(waiting)
    for tick in range(period):
        while waiting and waiting[0][0] <= tick:
            _, key = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(ticks[key]) + 1) * period // shares[key]), key))
        _, key = heapq.heappop(ready)
        ticks[key].append(tick)
        if (done := len(ticks[key])) < shares[key]:
            heapq.heappush(waiting, (done * period // shares[key], key))
    return ticks


@dataclass
class Plan:
    """Phases and the ticks of their periods; both grow with the number of sources, not of documents."""

    phases: list[tuple]
    ticks: list[tuple]


def planned(blocks: dict[str, int], shares: dict[str, int]) -> Plan:
    """Which block goes where, given the number of blocks of each source."""
    left, given, start = {k: n for k, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0
    plan = Plan([], [])
    while left:
        phase = len({p[1] for p in plan.phases})
        ticks = edf_period({k: shares[k] for k in left})
        period = sum(shares[k] for k in left)

        def tick_of(key: str, block: int) -> int:
            return block // shares[key] * period + ticks[key][block % shares[key]]

        end = min(tick_of(k, n - 1) for k, n in left.items()) + 1  # the first source to run out ends the phase
        for key in sorted(left):
            whole, rest = divmod(end, period)
            taken = whole * shares[key] + sum(t < rest for t in ticks[key])
            plan.phases.append((key, phase, given[key], given[key] + taken, start, shares[key], period))
            plan.ticks.extend((key, phase, turn, tick) for turn, tick in enumerate(ticks[key]))
            given[key] += taken
            left[key] -= taken
        left = {k: n for k, n in left.items() if n}
        start += end
    return plan


def damped_shares(rows: dict[str, int], power: float = 0.5, period: int = PERIOD) -> dict[str, int]:
    """Shares as the power of each source's size, so that large sources do not drown small ones."""
    weight = {k: n**power for k, n in rows.items()}
    total = sum(weight.values()) or 1.0
    return {k: max(1, round(period * w / total)) for k, w in weight.items()}


def source_key(source: str) -> Column:
    """Sources as keys; a null source is a source of its own."""
    return F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))


def mixed(
    docs: DataFrame, shares: dict[str | None, int] | None = None, block_rows: int = BLOCK_ROWS, bucket_rows: int = BUCKET_ROWS,
    source: str = "source",
) -> DataFrame:
    """All of ``docs`` with mix_phase, mix_slot (place of the block), mix_row (place in it), mix_share, mix_period.

    ``shares`` are whole target weights by source (None stands for a null source); sources without one, and
    all if ``shares`` is None, get a share by the square root of their size. Within a source documents
    are taken in the order of a digest of the whole row. A source's ranks are counted in buckets of that
    digest, without the rows themselves, so no task sorts a whole source. Rows with equal or null keys are documents like others; rows that
    are equal throughout are counted before the exchange and take places next to each other. No rows give no rows. Columns named like the
    new ones are replaced. More than MOST_SOURCES sources are refused: the schedule is a table on the driver.
    """
    new = ("mix_phase", "mix_slot", "mix_row", "mix_share", "mix_period")
    docs = docs.drop(*new)
    spark = docs.sparkSession
    sized = {r["k"]: r["n"] for r in docs.groupBy(source_key(source).alias("k")).agg(F.count("*").alias("n")).collect()}
    if len(sized) > MOST_SOURCES:
        raise ValueError(f"{len(sized)} sources; group them into {MOST_SOURCES} at most")
    targets = damped_shares(sized)
    targets |= {"" if name is None else f"={name}": share for name, share in (shares or {}).items()}
    plan = planned({k: -(-n // block_rows) for k, n in sized.items()}, {k: targets[k] for k in sized})
    buckets = max(1, math.ceil(max(sized.values(), default=0) / bucket_rows))
    return _placed(spark, docs, plan, buckets, block_rows, source)


def _ranks(rows: DataFrame, buckets: int) -> DataFrame:
    """key, h, n (rows with this digest) and the rank of the first of them in its source, from 0."""
    kinds = rows.groupBy("key", "h").agg(F.count("*").alias("n")).withColumn("bucket", F.pmod(F.shiftright("h.a", 20), F.lit(buckets)))
    counts = kinds.groupBy("key", "bucket").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("key", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("key", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    placed = kinds.withColumn("earlier", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["key", "bucket"])
    return placed.select("key", "h", "n", (F.col("start") + F.col("earlier")).alias("rank"))


def _ranked(docs: DataFrame, buckets: int, source: str) -> DataFrame:
    """row, key and rank of each document. Rows meet their rank by their digest; of those that repeat one is kept and listed n times."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    digest = F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *reversed(columns)).alias("b"))
    rows = docs.select(F.struct(*columns).alias("row"), source_key(source).alias("key"), digest.alias("h"))
    ranks = written(_ranks(rows.select("key", "h"), buckets))
    met = rows.join(ranks, ["key", "h"])
    if ranks.where("n > 1").isEmpty():
        return met.select("row", "key", "rank")
    single = met.where("n = 1").select("row", "key", "rank")
    kinds = met.where("n > 1").groupBy("key", "h").agg(F.first("row").alias("row"), F.first("n").alias("n"), F.first("rank").alias("rank"))
    parts = kinds.withColumn("part", F.expr(f"explode(sequence(0L, (n - 1) div {COPIES}))")).repartition("key", "h", "part")
    low, high = F.col("part") * COPIES, F.least(F.col("n"), (F.col("part") + 1) * COPIES) - 1
    copies = parts.withColumn("copy", F.explode(F.sequence(low, high))).select("row", "key", (F.col("rank") + F.col("copy")).alias("rank"))
    return single.unionByName(copies)


def _placed(spark: SparkSession, docs: DataFrame, plan: Plan, buckets: int, block_rows: int, source: str) -> DataFrame:
    rank = F.col("rank")
    ranked = _ranked(docs, buckets, source).select(
        "row", "key", F.floor(rank / block_rows).alias("block"), (rank % block_rows).cast("int").alias("mix_row")
    )
    phases = F.broadcast(spark.createDataFrame(plan.phases, SCHEMA_PHASES))  # sources x phases rows
    ticks = F.broadcast(spark.createDataFrame(plan.ticks, SCHEMA_TICKS))  # periods of all phases
    in_phase = ranked.join(phases, "key").where(F.col("block").between(F.col("first_block"), F.col("next_block") - 1))
    turns = in_phase.withColumn("nth", F.col("block") - F.col("first_block")).withColumn("turn", F.col("nth") % F.col("share"))
    slot = F.col("phase_start") + F.floor(F.col("nth") / F.col("share")) * F.col("period") + F.col("tick")
    return turns.join(ticks, ["key", "phase", "turn"]).select(
        "row.*", F.col("phase").alias("mix_phase"), slot.cast("long").alias("mix_slot"), "mix_row",
        F.col("share").alias("mix_share"), F.col("period").alias("mix_period"),
    )
