"""Ordered work per entity that survives a hot entity.

A plain ``Window.partitionBy("entity_id")`` puts all rows of an entity into one task. Here an
entity with more than ``HOT_ROWS`` rows is cut into time slices, the windows run per
(entity, slice), and what a slice needs from earlier ones is carried over:

* ``running`` carries totals and the last row (enough for sums, counts and lags),
* ``with_context`` carries the last k rows (for windows over the previous k rows).

Other entities stay whole (slice 0). The table of hot entities holds at most rows / HOT_ROWS
entries, which is the bound behind its broadcast. Whether there is one at all is found by a count
over the id column; without one the carry is left out of the plan. Lookups by entity have the
same trouble and salt the hot ones (``entity_lookup``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions.clock import div, second_of
from logvigil.session import written

HOT_ROWS = 2_000_000
DECIDED = -1  # as hot_rows: the rows come from with_width already
EVENT_ORDER = ("ts_us", "event_id")


def find_hot(events: DataFrame, hot_rows: int | None = None) -> DataFrame | None:
    """The hot entities as a small table (entity_id, width, parts), or None if there are none.

    ``width`` is a slice length in seconds. It follows from the entity's busiest second, so no
    slice can exceed ``hot_rows`` rows (unless a single second does). ``parts`` is the number of
    pieces for lookups. The count reads one column; run it on the scanned log.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    slim = events.select("entity_id", second_of(F.col("ts_us")).alias("sec"))
    hot = slim.groupBy("entity_id").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    if hot.isEmpty():
        return None
    peaks = (
        slim.join(F.broadcast(hot.select("entity_id")), "entity_id", "left_semi")
        .groupBy("entity_id", "sec")
        .agg(F.count("*").alias("n"))
        .groupBy("entity_id")
        .agg(F.max("n").alias("peak"), F.sum("n").alias("n"))
    )
    width = F.greatest(F.lit(1), div(F.lit(hot_rows), F.col("peak")))
    return written(peaks.select("entity_id", width.alias("width"), (div(F.col("n"), hot_rows) + 1).alias("parts")))


def mark_hot(events: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Add ``width`` for hot entities (NULL for others); nothing where none is hot."""
    return events if hot is None else events.join(F.broadcast(hot.select("entity_id", "width")), "entity_id", "left")


def with_width(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """:func:`find_hot` and :func:`mark_hot` in one, unless the rows are marked already.

    Further down a longer chain pass ``hot_rows=DECIDED``.
    """
    if is_sliced(events) or hot_rows == DECIDED:
        return events
    return mark_hot(events, find_hot(events, hot_rows))


def entity_lookup(events: DataFrame, table: DataFrame, hot: DataFrame | None = None, how: str = "left") -> DataFrame:
    """Join a table with one row per entity. Rows of a hot entity are salted into its parts, and
    its table row is repeated once per part (at most rows / HOT_ROWS repetitions in total)."""
    if hot is None:
        return events.join(table, "entity_id", how)
    parts = F.broadcast(hot.select("entity_id", "parts"))
    last = F.coalesce("parts", F.lit(1))
    left = events.join(parts, "entity_id", "left").withColumn("salt", F.pmod(F.xxhash64("event_id"), last)).drop("parts")
    right = table.join(parts, "entity_id", "left")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), last - 1))).drop("parts")
    return left.join(right, ["entity_id", "salt"], how).drop("salt")


def is_sliced(rows: DataFrame) -> bool:
    return "width" in rows.columns


def _add_slice(rows: DataFrame) -> DataFrame:
    if not is_sliced(rows):
        return rows.withColumn("slice", F.lit(0).cast("long"))
    number = div(second_of(F.col("ts_us")), F.col("width"))
    return rows.withColumn("slice", F.when(F.col("width").isNull(), F.lit(0)).otherwise(number).cast("long"))


def _spread(rows: DataFrame) -> DataFrame:
    """Exchange sliced rows on (entity, slice). A window alone would keep rows where they are if
    they already are partitioned by entity, and leave the hot one in one task."""
    return rows.repartition("entity_id", "slice") if is_sliced(rows) else rows


def _sliced(order_by=EVENT_ORDER):
    return Window.partitionBy("entity_id", "slice").orderBy(*[F.col(c).asc_nulls_first() for c in order_by])


def running(
    rows: DataFrame,
    sums: tuple[str, ...] = (),
    previous: Column | None = None,
    order_by: tuple[str, ...] = EVENT_ORDER,
) -> DataFrame:
    """Replace each column of ``sums`` by its running total per entity, current row included.

    ``previous`` adds column ``prev``: that expression's last non-NULL value strictly before the row
    (without ``sums`` simply the row before, whose value must not be NULL).
    Takes rows from :func:`with_width`.
    """
    hot = is_sliced(rows)
    rows = _add_slice(rows)
    if previous is not None:
        rows = rows.withColumn("here", previous)
    if hot:
        rows = _spread(rows).join(_carry(rows, sums, previous is not None, order_by), ["entity_id", "slice"], "left")
    upto = _sliced(order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {c: F.sum(c).over(upto) for c in sums}
    if previous is not None:
        if sums:
            before = _sliced(order_by).rowsBetween(Window.unboundedPreceding, -1)
            out["prev"] = F.last("here", ignorenulls=True).over(before)
        else:  # plain rows only, none to skip
            out["prev"] = F.lag("here").over(_sliced(order_by))
    if hot:
        out = {c: _plus_carry(c, value) for c, value in out.items()}
    rows = rows.withColumns(out)
    return rows.drop("slice", "here", "carry_prev", *[f"carry_{c}" for c in sums])


def _plus_carry(name: str, value: Column) -> Column:
    carry = F.col(f"carry_{name}")
    return F.coalesce(value, carry) if name == "prev" else value + F.coalesce(carry, F.lit(0))


def _carry(rows: DataFrame, sums: tuple[str, ...], previous: bool, order_by) -> DataFrame:
    """Per hot slice: the totals and the last row of the slices before it."""
    totals = [F.sum(c).alias(c) for c in sums]
    if previous:
        at = F.when(F.col("here").isNotNull(), F.struct(*[F.col(c) for c in order_by]))
        totals.append(F.max_by("here", at).alias("here"))
    earlier = Window.partitionBy("entity_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(c).over(earlier).alias(f"carry_{c}") for c in sums]
    if previous:
        carried.append(F.last("here", ignorenulls=True).over(earlier).alias("carry_prev"))
    hot = rows.where(F.col("width").isNotNull())
    return hot.groupBy("entity_id", "slice").agg(*totals).select("entity_id", "slice", *carried)


def with_previous(events: DataFrame, *columns: str, hot_rows: int | None = None) -> DataFrame:
    """Add ``prev``, a struct of those columns from the entity's previous event."""
    rows = running(with_width(events, hot_rows), previous=F.struct(*columns))
    return rows if is_sliced(events) else rows.drop("width")


def with_context(rows: DataFrame, depth: int) -> DataFrame:
    """Add ``slice`` and ``context``; hot slices also get the ``depth`` rows before them as context.

    Windows over (entity, slice) reaching at most ``depth`` rows back are then exact for rows with
    ``context = false``. Takes rows from :func:`with_width`.
    """
    hot = is_sliced(rows)
    rows = _add_slice(rows)
    if not hot:
        return rows.withColumn("context", F.lit(False))
    columns = rows.columns
    newest = Window.partitionBy("entity_id", "slice").orderBy(*[F.col(c).desc() for c in EVENT_ORDER])
    tails = (
        _spread(rows.where(F.col("width").isNotNull()))
        .withColumn("back", F.row_number().over(newest))
        .where(F.col("back") <= depth)
    )
    per_entity = Window.partitionBy("entity_id").orderBy(*EVENT_ORDER)
    halo = (
        tails.withColumn("halo", F.collect_list(F.struct(*columns)).over(per_entity.rowsBetween(-depth, -1)))
        .withColumn("last_slice", F.lag("slice").over(per_entity))
        .where(F.col("slice") != F.col("last_slice"))
        .select(F.col("slice").alias("into"), F.explode("halo").alias("r"))
        .select("r.*", "into")
        .withColumn("slice", F.col("into"))
        .select(*columns, F.lit(True).alias("context"))
    )
    return _spread(rows.withColumn("context", F.lit(False)).unionByName(halo))


def row_window(first: int, last: int):
    """Frame of rows [first, last] around the current one, after :func:`with_context`."""
    return _sliced().rowsBetween(first, last)


def drop_context(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("context")).drop("context", "slice")


def entity_tail(events: DataFrame, n: int) -> DataFrame:
    """Last n events per entity; the limit also runs on the map side, before the exchange."""
    newest = Window.partitionBy("entity_id").orderBy(F.col("ts_us").desc(), F.col("event_id").desc())
    return events.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= n)


def monotonic_repair(events: DataFrame, step_us: int = 1, hot_rows: int | None = None) -> DataFrame:
    """Make ``ts_us`` strictly increasing per entity with the least shift, as ``fixed_ts_us``.

    The i-th repaired time is i*step + max over j<=i of (t_j - j*step). Slices combine: the
    maximum of a slice is shifted by the number of rows before it.
    """
    rows = with_width(events, hot_rows)
    hot = is_sliced(rows)
    rows = _spread(_add_slice(rows))
    rows = rows.withColumn("pos", F.row_number().over(_sliced()).cast("long"))
    rows = rows.withColumn("lead_us", F.col("ts_us") - F.col("pos") * step_us)
    peak = F.max("lead_us").over(_sliced().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shift = F.lit(0)
    if hot:
        earlier = Window.partitionBy("entity_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        summary = (
            rows.where(F.col("width").isNotNull())
            .groupBy("entity_id", "slice")
            .agg(F.count("*").alias("n"), F.max("lead_us").alias("high"))
            .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .withColumn("high", F.max(F.col("high") - F.col("before") * step_us).over(earlier))
            .select("entity_id", "slice", "before", "high")
        )
        rows = rows.join(summary, ["entity_id", "slice"], "left")
        shift = F.coalesce(F.col("before"), F.lit(0)) * step_us
        peak = F.greatest(peak - shift, F.col("high"))
    rows = rows.withColumn("fixed_ts_us", peak + F.col("pos") * step_us + shift)
    return rows.drop("slice", "pos", "lead_us", "before", "high", "width")
