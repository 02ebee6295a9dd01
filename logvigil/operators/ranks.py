"""Exact ranks, percentiles and running totals over a global order, without a global sort.

* For an order statistic a sample gives a grid of quantiles and the grid a bracket around the rank.
  Inside the bracket the same is done again until it is small; then its distinct values are counted
  exactly. The counts prove that the rank lies inside, so chance only touches the number of passes.
* A running total over a global order is cut into value bins: bin totals give the offsets, and a
  window per bin does the rest.

Every pass reads one column, and no task gets more than a sample or a small bracket.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = 1000
SLACK = 4  # grid cells; the sample's error is about one cell
SAMPLE = 4_000_000
ACCURACY = 10_000
SMALL = 1_000_000
MAX_BINS = 4096


def _grid(values: DataFrame, low, high, expected: int) -> tuple[int, int, list]:
    """Rows below the bracket, rows inside it, and the edges of GRID cells of about equal count."""
    inside = F.lit(True) if low is None else F.col("v").between(F.lit(low), F.lit(high))
    below = F.lit(False) if low is None else F.col("v") < F.lit(low)
    keep = min(1.0, SAMPLE / max(1, expected))
    drawn = values.select("v", below.alias("below"), F.when(inside, F.col("v")).alias("w"), (F.rand(17) < keep).alias("kept"))
    row = drawn.agg(
        F.count_if("below").alias("below"), F.count("w").alias("inside"), F.min("w").alias("first"), F.max("w").alias("last"),
        F.percentile_approx(F.when(F.col("kept"), F.col("w")), [i / GRID for i in range(1, GRID)], ACCURACY).alias("q"),
    ).first()
    return row["below"], row["inside"], [row["first"], *(row["q"] or []), row["last"]]


def _count_out(values: DataFrame, ranks: list[int], low=None, high=None) -> dict[int, tuple]:
    """rank -> (value, rows below it, rows equal to it) for the ranks inside the bracket."""
    # everything below the bracket falls into one NULL group, which sorts first
    if low is not None:
        values = values.where(F.col("v") <= F.lit(high)).select(F.when(F.col("v") >= F.lit(low), F.col("v")).alias("v"))
    counted = values.groupBy("v").agg(F.count("*").alias("n"))
    upto = Window.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    hit = F.lit(False)
    for rank in ranks:
        hit = hit | ((F.col("before") <= rank) & (F.col("before") + F.col("n") > rank))
    rows = placed.where(hit & F.col("v").isNotNull()).collect()  # at most one row per rank
    return {r: (w["v"], w["before"], w["n"]) for r in ranks for w in rows if w["before"] <= r < w["before"] + w["n"]}


def _narrow(values: DataFrame, ranks: list[int], n: int, whole: list) -> dict[int, tuple]:
    """Bracket neighbouring ranks until few rows (or a single value) are left, then count them out."""
    slack = SLACK
    while True:
        low = high = None
        below, inside, edges = 0, n, whole
        while inside > SMALL:
            cells = [(r - below) * (len(edges) - 1) // inside for r in (min(ranks), max(ranks))]
            bracket = edges[max(0, cells[0] - slack)], edges[min(len(edges) - 1, cells[1] + 1 + slack)]
            if bracket == (low, high):
                break
            low, high = bracket
            below, inside, edges = _grid(values, low, high, inside * (2 * slack + 2) // GRID)
            if low == high or not below <= min(ranks) <= max(ranks) < below + inside:
                break
        found = _count_out(values, ranks, low, high)
        if len(found) == len(ranks):
            return found
        slack *= 8  # the sample misled: from GRID cells on the bracket is everything


def order_statistics(
    df: DataFrame, column: str | Column, fractions: list[float], ranks_of: Callable[[int, float], list[int]]
) -> tuple[int, list[dict[int, tuple]]]:
    """Row count and, per fraction, rank -> (value, rows below, rows equal) for the neighbouring
    ranks ``ranks_of(n, fraction)``, counted from 0."""
    value = F.col(column) if isinstance(column, str) else column
    values = df.select(value.alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    wanted = [sorted(set(ranks_of(n, f))) if n else [] for f in fractions]
    if n <= SMALL:
        found = _count_out(values, sorted({r for ranks in wanted for r in ranks})) if any(wanted) else {}
        return n, [{r: found[r] for r in ranks} for ranks in wanted]
    _, _, whole = _grid(values, None, None, n)
    return n, [_narrow(values, ranks, n, whole) if ranks else {} for ranks in wanted]


def exact_percentile(df: DataFrame, column: str | Column, *fractions: float) -> list[float | None]:
    """Percentiles with linear interpolation between the two neighbouring rows."""

    def neighbours(n: int, fraction: float) -> list[int]:
        place = fraction * (n - 1)
        return sorted({math.floor(place), math.ceil(place)})

    n, found = order_statistics(df, column, list(fractions), neighbours)
    results = []
    for fraction, located in zip(fractions, found, strict=True):
        if not n:
            results.append(None)
            continue
        place = fraction * (n - 1)
        low, high = located[math.floor(place)][0], located[math.ceil(place)][0]
        results.append(float(low) + (float(high) - float(low)) * (place - math.floor(place)))
    return results


def chrono_cuts(events: DataFrame, fractions: tuple[float, ...] = (0.70, 0.85)) -> list[tuple | None]:
    """Key (ts_us, event_id) of the last row of each part in the order (ts_us, event_id).

    ``event_id`` is None where all rows of that instant belong to the part; a part without rows
    gives None. Nothing is sorted: splitting is a comparison with these constants.
    """

    def last(n: int, fraction: float) -> list[int]:
        rank = int(fraction * n) - 1
        return [rank] if rank >= 0 else []

    n, found = order_statistics(events, "ts_us", list(fractions), last)
    cuts: list[tuple | None] = []
    for fraction, located in zip(fractions, found, strict=True):
        if not located:
            cuts.append(None)
            continue
        ((rank, (ts_us, before, ties)),) = located.items()
        event_id = None
        if rank + 1 < before + ties:
            instant = events.where(F.col("ts_us") == ts_us).select("event_id").orderBy("event_id")
            event_id = instant.offset(rank - before).limit(1).first()["event_id"]
        cuts.append((ts_us, event_id))
    return cuts


def _upto(cut: tuple | None) -> Column:
    if cut is None:
        return F.lit(False)
    ts_us, event_id = cut
    if event_id is None:
        return F.col("ts_us") <= ts_us
    return (F.col("ts_us") < ts_us) | ((F.col("ts_us") == ts_us) & (F.col("event_id") <= F.lit(event_id)))


def add_split(events: DataFrame, cuts: list[tuple | None]) -> DataFrame:
    """Add ``split``: train, val or test."""
    train, val = cuts
    return events.withColumn(
        "split", F.when(_upto(train), F.lit("train")).when(_upto(val), F.lit("val")).otherwise(F.lit("test"))
    )


def chrono_split(events: DataFrame, fractions: tuple[float, float] = (0.70, 0.85)) -> DataFrame:
    return add_split(events, chrono_cuts(events, fractions))


def with_bins(df: DataFrame, column: str, rows_per_bin: int = SMALL) -> DataFrame:
    """Add ``bin``, ascending in ``column``, with about ``rows_per_bin`` rows each.

    Rows that fit into one bin come back as they are. ``column`` must be (nearly) unique, and ``df`` cheap to read twice.
    """
    n = df.count()
    bins = min(MAX_BINS, math.ceil(n / rows_per_bin))
    if bins <= 1:
        return df
    marks = [i / bins for i in range(1, bins)]
    drawn = df.select(column) if n <= SAMPLE else df.select(column).sample(SAMPLE / n, seed=17)
    bounds = drawn.agg(F.percentile_approx(column, marks, ACCURACY).alias("q")).first()["q"]
    edges = F.array(*[F.lit(b) for b in sorted(set(bounds or []))])
    return df.withColumn("bin", F.size(F.filter(edges, lambda edge: edge < F.col(column))))


def running_totals(
    df: DataFrame, column: str, sums: tuple[str, ...], descending: bool = False, rows_per_bin: int = SMALL,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``cum_<c>`` for each column of ``sums``: total over all rows up to this one in the order
    of ``column`` (then ``ties``)."""
    binned = with_bins(df, column, rows_per_bin)

    def direction(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    order = [direction(column), *[F.col(t).asc() for t in ties]]
    if "bin" not in binned.columns:  # one bin, at most rows_per_bin rows
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({f"cum_{c}": F.sum(c).over(upto) for c in sums})
    # one row per bin, at most MAX_BINS
    earlier = Window.orderBy(direction("bin")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        binned.groupBy("bin")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select("bin", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"off_{c}") for c in sums])
    )
    within = Window.partitionBy("bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = binned.join(F.broadcast(offsets), "bin").withColumns(
        {f"cum_{c}": F.sum(c).over(within) + F.col(f"off_{c}") for c in sums}
    )
    return out.drop("bin", *[f"off_{c}" for c in sums])
