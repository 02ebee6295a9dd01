"""Detection metrics as aggregations.

Curves are built on one row per distinct score, so a score shared by a third of all events is one
row. The running counts come from value bins, not from one global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.operators.ranks import SMALL, exact_percentile, running_totals
from logvigil.session import written

TOP_QUANTILE = 0.99
METRICS = ("roc_auc", "pr_auc", "fpr_at_1", "precision_at_1")


MAX_CLASSES = 100  # more values of a label than a taxonomy has

def score_curve(scored: DataFrame, score: str = "score", positive: str = "y", rows_per_bin: int = SMALL) -> DataFrame:
    """One row per distinct score: tp, fp and their totals at or above that score."""
    grouped = scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(positive).cast("long")).alias("tp"), F.sum(1 - F.col(positive).cast("long")).alias("fp")
    )
    # read three times below: written once to the shared folder instead of scored again
    return running_totals(written(grouped), "score", ("tp", "fp"), descending=True, rows_per_bin=rows_per_bin)


def roc_auc_of() -> Column:
    """Over a curve: share of (positive, negative) pairs ranked right, ties half."""
    wins = F.sum(F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2.0))
    return F.try_divide(wins, F.sum("tp") * F.sum("fp").cast("double"))


def pr_auc_of() -> Column:
    """Over a curve: trapezoids under precision over recall, starting at recall 0 with precision 1."""
    precision = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    tp, fp = F.col("cum_tp") - F.col("tp"), F.col("cum_fp") - F.col("fp")
    before = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(1.0))
    return F.try_divide(F.sum(F.col("tp") * (precision + before) / 2.0), F.sum("tp").cast("double"))


def curve_metrics(curve: DataFrame) -> DataFrame:
    return curve.agg(roc_auc_of().alias("roc_auc"), pr_auc_of().alias("pr_auc"))


def top_counts(scored: DataFrame, score: str = "score", positive: str = "y") -> DataFrame:
    """One row: fp, tn, tp at or above the 99th percentile, and that threshold."""
    (threshold,) = exact_percentile(scored, score, TOP_QUANTILE)
    flagged, y = F.col(score) >= F.lit(threshold), F.col(positive) == 1
    return scored.agg(
        F.count_if(flagged & ~y).alias("fp"), F.count_if(~flagged & ~y).alias("tn"), F.count_if(flagged & y).alias("tp"),
        F.lit(threshold).alias("threshold"),
    )


def _rate(top: str, bottom: tuple[str, str]) -> Column:
    total = (F.col(bottom[0]) + F.col(bottom[1])).cast("double")
    return F.coalesce(F.try_divide(F.col(top).cast("double"), total), F.lit(0.0))


def fpr_at_top1(scored: DataFrame, score: str = "score", positive: str = "y") -> DataFrame:
    return top_counts(scored, score, positive).select(_rate("fp", ("fp", "tn")).alias("fpr_at_1"), "threshold")


def precision_at_top1(scored: DataFrame, score: str = "score", positive: str = "y") -> DataFrame:
    return top_counts(scored, score, positive).select(_rate("tp", ("fp", "tp")).alias("precision_at_1"), "threshold")


def model_comparison(scored: DataFrame, models: dict[str, str], positive: str = "y") -> DataFrame:
    """One row per model (name -> score column) with its metrics; ``best`` marks the best ROC area,
    the first name winning ties. ``scored`` is read several times: pass a table."""
    parts = []
    for name, column in models.items():
        curve = curve_metrics(score_curve(scored, column, positive)).withColumn("model", F.lit(name))
        top = top_counts(scored, column, positive).select(
            F.lit(name).alias("model"), _rate("fp", ("fp", "tn")).alias("fpr_at_1"), _rate("tp", ("fp", "tp")).alias("precision_at_1")
        )
        both = curve.unionByName(top, allowMissingColumns=True).groupBy("model")
        parts.append(both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in METRICS]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    ranked = Window.orderBy(F.col("roc_auc").desc_nulls_last(), "model")  # one row per model
    return rows.withColumn("best", (F.row_number().over(ranked) == 1).cast("int"))


def confusion_counts(predictions: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return predictions.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(predictions: DataFrame, classes: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row per actual class, one column per predicted class."""
    counts = confusion_counts(predictions, actual, predicted)
    return counts.groupBy("actual").agg(
        *[F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).cast("long").alias(c) for c in classes]
    )


def classification_report(predictions: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy, macro and weighted averages."""
    counts = confusion_counts(predictions, actual, predicted)  # classes squared, however many events
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("named"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("named"),
                 F.lit(0).cast("long").alias("hit")),
    )
    totals = (
        counts.select(F.explode(sides).alias("s")).select("s.*").groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("hit").alias("hit"))
    )

    def share(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    rates = totals.select(
        "class", share(F.col("hit"), F.col("named")).alias("precision"), share(F.col("hit"), F.col("support")).alias("recall"),
        "support", "hit",
    )
    rates = rates.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    rates = written(rates)
    measures = ("precision", "recall", "f1")
    support = F.sum("support")
    macro = rates.agg(*[F.avg(m).alias(m) for m in measures], support.alias("support"))
    weighted = rates.agg(*[(F.sum(F.col(m) * F.col("support")) / support).alias(m) for m in measures], support.alias("support"))
    accuracy = rates.agg(*[(F.sum("hit") / support).alias(m) for m in measures], support.alias("support"))
    out = rates.select("class", *measures, "support")
    for name, part in (("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(part.withColumn("class", F.lit(name)))
    return out


def balanced_weights(rows: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = rows / (classes * rows of the class); rows without a class are left out.

    The counts, one row a class, come to the driver and go into the plan as literals: rows are not shuffled by class.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values; it is no class")
    total = sum(r["n"] for r in counts)
    weight = F.lit(None).cast("double")
    for r in sorted(counts, key=lambda r: (r["n"], str(r[label]))):  # the last one is asked first: the largest class
        weight = F.when(F.col(label) == r[label], F.lit(total / (r["n"] * len(counts)))).otherwise(weight)
    return rows.where(F.col(label).isNotNull()).withColumn("weight", weight)


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """min, max, mean, sample std, median, one row per column."""
    out = None
    for c in columns:
        (median,) = exact_percentile(df, c, 0.5)
        part = df.agg(
            F.lit(c).alias("feature"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.lit(median).alias("median"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def class_distribution(labels: DataFrame) -> DataFrame:
    """Count and percent per label, plus the total share of anomalies on every row."""
    counts = labels.groupBy("label").agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(1))  # one row per label
    rows = F.sum("n").over(everything)
    odd = F.coalesce(F.sum(F.when(F.col("label") != "normal", F.col("n"))).over(everything), F.lit(0))
    return counts.select("label", "n", (F.col("n") / rows * 100.0).alias("pct"), (odd / rows * 100.0).alias("anomaly_rate"))
