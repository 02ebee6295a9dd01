"""Seeded sampling. Order comes from a digest of seed and id, so a row's fate does not depend on
partitions, order or reruns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values
SAMPLE_CAP = 20_000
FOLDS = 5
BUCKET_DIGITS = 3


def digest(seed: int, key: str = "event_id", salt: str = "") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), F.col(key).cast("string")))


def downsample_cap(rows: DataFrame, cap: int = SAMPLE_CAP, seed: int = 42, key: str = "event_id") -> DataFrame:
    """At most ``cap`` rows without replacement: those with the smallest digests.

    Only digests below a bound that lets about two caps through are ranked; a count proves that
    the bound let enough through, else it is doubled.
    """
    drawn = rows.withColumn("digest", digest(seed, key))
    total = rows.count()
    share = 2.0 * cap / max(1, total)
    few = drawn
    while share < 0.5:
        few = drawn.where(F.col("digest") < f"{int(share * 16**8):08x}")
        if few.count() >= cap:
            break
        share, few = share * 2, drawn
    return few.orderBy("digest", key).limit(cap).drop("digest")


def sample_replace(rows: DataFrame, n: int = 15, seed: int = 42, key: str = "event_id") -> DataFrame:
    """n independent draws with replacement: each draw takes the row with its smallest digest.

    One pass; every task hands on at most one row per draw.
    """
    draws = [
        F.min_by(F.struct(*rows.columns), F.struct(digest(seed, key, str(i)), F.col(key))).alias(f"d{i}") for i in range(n)
    ]
    picked = F.array(*[F.struct(F.lit(i).alias("draw"), F.col(f"d{i}").alias("row")) for i in range(n)])
    return rows.agg(*draws).select(F.explode(picked).alias("p")).where(F.col("p.row").isNotNull()).select("p.draw", "p.row.*")


def stratified_folds(rows: DataFrame, label: str, folds: int = FOLDS, seed: int = 42, key: str = "event_id") -> DataFrame:
    """Add ``fold``: within each class the rows in digest order go to the folds in turn.

    A class is cut into digest buckets and the bucket sizes give each bucket its first place, so
    that a class with a third of all rows is ranked by many tasks.
    """
    rows = rows.withColumn("digest", digest(seed, key)).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    earlier = Window.partitionBy(label).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # 16 ** BUCKET_DIGITS rows per class at most
    offsets = (
        rows.groupBy(label, "bucket")
        .agg(F.count("*").alias("n"))
        .select(label, "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    place = F.row_number().over(Window.partitionBy(label, "bucket").orderBy("digest", key))
    return (
        rows.join(offsets, [label, "bucket"])
        .withColumn("fold", ((F.col("before") + place - 1) % folds).cast("int"))
        .drop("digest", "bucket", "before")
    )
