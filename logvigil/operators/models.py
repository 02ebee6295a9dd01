"""Anomaly models and the threat classifier, trained and applied as Spark jobs."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions import rules
from logvigil.operators.metrics import balanced_weights
from logvigil.operators.sampling import stratified_folds
from logvigil.session import discard, written

# fixed values
TREES, TREE_ROWS = 100, 256
EULER = 0.5772156649015329

PRIME = 2_147_483_647  # draws are linear in a row's digest, modulo this
SPARE_ROWS = 64  # rows that make a short draw all but impossible
DIGITS = 4  # of features: one that is constant but for the noise of its arithmetic is constant
NUDGE = 1e-9  # as in the registry of queries
SCORE_DIGITS = 9
POINTS_AT_ONCE = 500  # through all trees, in the cache of a core
CLASSES_AT_ONCE = 4  # boosted side by side
ROWS_A_FIT = 100_000  # of features that a task adds up for a level of a boosted tree
HEX = 1 << 32  # values of a digest's first eight digits


def _vector(features: tuple[str, ...]):
    return F.array(*[F.round(F.col(c).cast("double") + NUDGE, DIGITS) for c in features])


def _digest(*parts) -> int:
    """A number from 0 to HEX - 1 that is the same in every engine with md5."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def _digest_column(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def tree_rows(normal: DataFrame, features: tuple[str, ...], trees: int, rows_per_tree: int, seed: int) -> tuple[DataFrame, int]:
    """Rows tree, x of all trees, and how many each tree has.

    A tree takes the rows with the smallest draws of its own, so trees are independent at every size. A row is handed on only for
    the trees where its draw is below a bound that lets about twice the rows of a tree through.
    """
    total = normal.count()
    bound = int(PRIME * min(1.0, 2.0 * (rows_per_tree + SPARE_ROWS) / max(1, total)))
    factors = F.array(*[F.lit(1 + _digest(seed, t, "factor") % (PRIME - 1)) for t in range(trees)])
    addends = F.array(*[F.lit(_digest(seed, t, "addend") % PRIME) for t in range(trees)])
    draw = lambda t: (F.col("own") * factors[t] + addends[t]) % PRIME
    own = _digest_column(F.lit(seed), F.lit("row"), F.col("event_id")) % PRIME
    rows = normal.select("event_id", _vector(features).alias("x"), own.alias("own"))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < bound)
    dealt = rows.select("event_id", "x", "own", F.explode(drawn).alias("tree"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy(draw(F.col("tree")), "event_id"))
    per_tree = min(rows_per_tree, total)
    return dealt.withColumn("place", place).where(F.col("place") <= per_tree).select("tree", "x"), per_tree


def _level(rows: DataFrame, features: int, depth: int, limit: int, seed: int) -> DataFrame:
    """The nodes of one level: rows in each, and the feature and the cut of those that split.

    Feature and cut follow from a digest of tree and node, among the features that vary in the node.
    """
    x = F.col("x")
    ends = [F.struct(F.lit(i).alias("i"), F.min(x[i]).alias("low"), F.max(x[i]).alias("high")) for i in range(features)]
    nodes = rows.groupBy("tree", "node").agg(F.count("*").alias("n"), F.array(*ends).alias("ends"))
    vary = F.filter("ends", lambda e: e["high"] > e["low"])
    nodes = nodes.select("tree", "node", "n", vary.alias("vary"))
    pick = _digest_column(F.lit(seed), F.col("tree"), F.col("node"), F.lit("feature"))
    at = F.get("vary", (pick % F.size("vary")).cast("int"))
    share = _digest_column(F.lit(seed), F.col("tree"), F.col("node"), F.lit("cut")) / float(HEX)
    splits = (F.col("n") > 1) & (F.size("vary") > 0) & F.lit(depth < limit)
    nodes = nodes.withColumn("at", F.when(splits, at))
    cut = F.col("at.low") + share * (F.col("at.high") - F.col("at.low"))
    return nodes.select("tree", "node", "n", F.col("at.i").alias("feature"), cut.alias("cut"))


def isolation_forest_fit(
    normal: DataFrame, features: tuple[str, ...], trees: int = TREES, rows_per_tree: int = TREE_ROWS, seed: int = 42
) -> pd.DataFrame:
    """Nodes of the forest (at most 511 per tree), all trees grown together, level by level.

    A level is one aggregation over the rows of all trees. Its nodes come to the driver, at most trees * 2**depth of them, and go back as
    the table that sends the rows on.
    """
    rows, per_tree = tree_rows(normal, features, trees, rows_per_tree, seed)
    rows = written(rows.withColumn("node", F.lit(0)))
    limit = math.ceil(math.log2(max(2, per_tree)))
    spark, nodes = normal.sparkSession, []
    for depth in range(limit + 1):
        level = _level(rows, len(features), depth, limit, seed).toPandas()
        split = level["feature"].notna()
        left, right = 2 * level["node"] + 1, 2 * level["node"] + 2
        nodes.append(pd.DataFrame({
            "tree": level["tree"], "node": level["node"], "feature": level["feature"].fillna(-1).astype(int), "cut": level["cut"].fillna(0.0),
            "left": left.where(split, level["node"]), "right": right.where(split, level["node"]),
            "depth": [depth + _mean_path(int(n)) for n in level["n"]],
        }))
        if not split.any():
            break
        cuts = spark.createDataFrame(level.loc[split, ["tree", "node", "feature", "cut"]].astype({"feature": int}), "tree int, node int, feature int, cut double")
        side = F.when(F.get("x", F.col("feature")) > F.col("cut"), 2).otherwise(1)
        # written, so that all levels have one plan and none repeats the ones before it
        rows = written(rows.join(F.broadcast(cuts), ["tree", "node"]).select("tree", "x", (2 * F.col("node") + side).alias("node")))
    forest = pd.concat(nodes, ignore_index=True)
    forest.attrs["rows"] = per_tree
    return forest


def isolation_forest_score(
    events: DataFrame, forest: pd.DataFrame, features: tuple[str, ...], out: str = "iforest_score"
) -> DataFrame:
    """Add the score in (0, 1], high for anomalies. The forest is a fixed-size table."""
    rows_per_tree = forest.attrs.get("rows", TREE_ROWS)
    trees = sorted(forest["tree"].unique())
    width = int(forest["node"].max()) + 1
    shape = (len(trees), width)
    feature, cut = np.full(shape, -1), np.zeros(shape)
    left, right, depth = np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape)
    at = (forest["tree"].map({t: i for i, t in enumerate(trees)}).to_numpy(), forest["node"].to_numpy())
    for target, column in ((feature, "feature"), (cut, "cut"), (left, "left"), (right, "right"), (depth, "depth")):
        target[at] = forest[column].to_numpy()
    levels = math.ceil(math.log2(max(2, rows_per_tree)))
    # nodes of all trees in one line; a leaf is its own child, so a point that has arrived stays
    first = np.arange(len(trees))[:, None] * width
    line = (np.maximum(feature, 0).ravel(), cut.ravel(), (first + left).ravel(), (first + right).ravel(), depth.ravel(), first.ravel())
    shared = events.sparkSession.sparkContext.broadcast((line, levels, _mean_path(rows_per_tree)))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        (feature, cut, left, right, depth, first), levels, scale = shared.value
        for batch in batches:
            means = [np.empty(0)]
            for start in range(0, len(batch), POINTS_AT_ONCE):
                points = np.stack(batch.iloc[start : start + POINTS_AT_ONCE].to_numpy())
                row = np.arange(len(points))[:, None] * points.shape[1]
                node = np.repeat(first[None, :], len(points), axis=0)
                for _ in range(levels):
                    goes_left = points.take(row + feature.take(node)) <= cut.take(node)
                    node = np.where(goes_left, left.take(node), right.take(node))
                means.append(depth.take(node).mean(axis=1))
            yield pd.Series(np.power(2.0, -np.concatenate(means) / scale))

    return events.withColumn(out, score(_vector(features)))


@dataclass(frozen=True)
class OneClass:
    """Standardisation, random Fourier directions and the mean map of normal rows: fixed size."""

    features: tuple[str, ...]
    mean: np.ndarray
    std: np.ndarray
    directions: np.ndarray
    shift: np.ndarray
    centre: np.ndarray


def _fourier(points: np.ndarray, mean, std, directions, shift) -> np.ndarray:
    return math.sqrt(2.0 / len(shift)) * np.cos(((points - mean) / std) @ directions + shift)


def fourier_basis(columns: int, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Standard normal directions (columns by dims) and shifts from 0 to 2 pi, from digests of seed and place."""

    def even(*parts) -> float:
        return (_digest(seed, *parts) + 0.5) / HEX

    normal = lambda i, d: math.sqrt(-2.0 * math.log(even(i, d, "radius"))) * math.cos(2.0 * math.pi * even(i, d, "angle"))
    directions = np.array([[normal(i, d) for d in range(dims)] for i in range(columns)]).reshape(columns, dims)
    return directions, np.array([2.0 * math.pi * even(d, "shift") for d in range(dims)])


def one_class_fit(normal: DataFrame, features: tuple[str, ...], dims: int = 512, seed: int = 42) -> OneClass:
    """Random Fourier features stand in for the kernel (error about 1 / sqrt(dims)). Two passes over all normal rows: column moments, then the mean of the mapped rows."""
    x = _vector(features)
    moments = normal.agg(
        *[F.avg(x[i]).alias(f"m_{i}") for i in range(len(features))], *[F.stddev_pop(x[i]).alias(f"s_{i}") for i in range(len(features))]
    ).first()
    mean = np.array([moments[f"m_{i}"] for i in range(len(features))], dtype=float)
    spread = np.array([moments[f"s_{i}"] for i in range(len(features))], dtype=float)
    varying = int((spread > 0).sum())
    std = np.where(spread > 0, spread, 1.0)
    # kernel width 1 / (columns * variance); scaled columns have variance 1, or 0 if constant
    gamma = 1.0 / max(1, varying)
    directions, shift = fourier_basis(len(features), dims, seed)
    directions = math.sqrt(2.0 * gamma) * directions

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(dims), 0
        for batch in batches:
            if len(batch):
                total += _fourier(np.stack(batch["x"].to_numpy()), mean, std, directions, shift).sum(axis=0)
                rows += len(batch)
        if rows:
            yield pd.DataFrame({"dim": np.arange(dims), "total": total, "n": rows})

    sums = normal.select(_vector(features).alias("x")).mapInPandas(partial, "dim int, total double, n long")
    rows = sums.groupBy("dim").agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("dim").collect()
    return OneClass(features, mean, std, directions, shift, np.array([r["mean"] for r in rows]))


def one_class_score(events: DataFrame, model: OneClass, out: str = "one_class_score") -> DataFrame:
    """Add minus the mean kernel similarity to normal rows: high for anomalies."""
    mean, std, directions, shift, centre = model.mean, model.std, model.directions, model.shift, model.centre

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        return pd.Series(-(_fourier(np.stack(x.to_numpy()), mean, std, directions, shift) @ centre))

    return events.withColumn(out, score(_vector(model.features)))


def classifier_fit(
    flagged: DataFrame, features: tuple[str, ...], label: str = "target_class", trees: int = 40, depth: int = 6,
    seed: int = 42, boosted: bool = False, rounds: int = 200,
) -> PipelineModel:
    """Multi-class model with balanced class weights: a random forest, or boosted trees per class.

    Each level of each boosted tree is a job over all rows, thousands in all. So they are written first and read by as many tasks as their
    number asks for: more tasks only add to what every job starts, shuffles and reports.
    """
    stages = [
        StringIndexer(inputCol=label, outputCol="class_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=list(features), outputCol="vector"),
    ]
    common = {"featuresCol": "vector", "labelCol": "class_index", "weightCol": "weight"}
    if boosted:
        binary = GBTClassifier(maxIter=rounds, stepSize=0.05, maxDepth=depth, subsamplingRate=0.8, seed=seed)
        stages.append(OneVsRest(classifier=binary, parallelism=CLASSES_AT_ONCE, **common))
    else:
        stages.append(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **common))
    rows = flagged.select(label, *[F.col(c).cast("double").alias(c) for c in features])
    if not boosted:
        return Pipeline(stages=stages).fit(balanced_weights(rows, label))
    table = written(rows, {"spark.sql.files.maxRecordsPerFile": str(ROWS_A_FIT)})
    few = table.coalesce(max(1, math.ceil(table.count() / ROWS_A_FIT)))
    model = Pipeline(stages=stages).fit(balanced_weights(few, label))
    discard(table)
    return model


def class_names(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def importances(model: PipelineModel, features: tuple[str, ...]) -> dict[str, float]:
    return dict(zip(features, (float(v) for v in model.stages[2].featureImportances.toArray()), strict=True))


# fixed values: how many features speak for a prediction, and what stands beside the feature that tripped a rule
TOP_FEATURES, RULE_TRIGGER = 3, "rule_override_trigger"
TRIGGER_OF = {"impossible_travel": "geo_velocity_kmh", "brute_force": "failed_auth_count_5min"}


def top_features(ruled: Column, weights: dict[str, float]) -> Column:
    """(feature, weight) pairs behind a prediction: the trigger of the rule, or the largest absolute value times importance."""
    pair = lambda name, weight: F.struct(F.lit(name).alias("feature"), weight.alias("weight"))
    ranked = F.array_sort(
        F.array(*[
            F.struct((-F.abs(F.col(f).cast("double")) * w).alias("key"), F.lit(place).alias("place"), F.lit(f).alias("feature"))
            for place, (f, w) in enumerate(weights.items())
        ])
    )
    best = F.transform(F.slice(ranked, 1, TOP_FEATURES), lambda c: F.struct(c["feature"].alias("feature"), (-c["key"]).alias("weight")))
    for attack, trigger in TRIGGER_OF.items():
        best = F.when(ruled == attack, F.array(pair(trigger, F.lit(1.0)), pair(RULE_TRIGGER, F.lit(1.0)))).otherwise(best)
    return best


def predict(events: DataFrame, model: PipelineModel, weights: dict[str, float] | None = None) -> DataFrame:
    """Add ``predicted_attack_type``, ``confidence`` and ``prediction_source``: rule first, then model.

    With ``weights`` (importances of the features) also ``top_features``.
    """
    names = F.array(*[F.lit(n) for n in class_names(model)])
    signals = [F.col(c) for c in ("geo_velocity_kmh", "geo_distance_prev_km", "failed_auth_count_5min")]
    ruled = rules.rule_class(*signals)
    # the indexer is only needed for fitting
    rows = model.stages[2].transform(model.stages[1].transform(events))
    if "probability" in rows.columns:
        # the extra class kept for unseen labels never had a row
        odds = F.slice(vector_to_array("probability"), 1, len(class_names(model)))
        best = F.array_max(odds)
        guess = F.element_at(names, F.array_position(odds, best).cast("int"))
    else:
        best = F.lit(None).cast("double")
        guess = F.element_at(names, (F.col("prediction") + 1).cast("int"))
    rows = rows.withColumns(
        {
            "predicted_attack_type": F.coalesce(ruled, guess),
            "confidence": F.when(ruled.isNotNull(), F.lit(1.0)).otherwise(best),
            "prediction_source": rules.prediction_source(*signals),
        }
    )
    if weights:
        rows = rows.withColumn("top_features", top_features(ruled, weights))
    return rows.drop("vector", "rawPrediction", "probability", "prediction")


def cv_oof(flagged: DataFrame, features: tuple[str, ...], label: str = "target_class", folds: int = 5, trees: int = 40,
           seed: int = 42) -> DataFrame:
    """Out-of-fold predictions with rule overrides: one fit per fold on the other folds, all fits at the same time."""
    rows = written(stratified_folds(flagged, label, folds, seed))

    def held_out(fold: int) -> DataFrame:
        model = classifier_fit(rows.where(F.col("fold") != fold), features, label, trees, seed=seed)
        return predict(rows.where(F.col("fold") == fold), model)

    with ThreadPool(folds) as pool:
        parts = pool.map(inheritable_thread_target(rows.sparkSession)(held_out), range(folds))
    return functools.reduce(DataFrame.unionByName, parts)


def baseline_candidates(scored: DataFrame, features: tuple[str, ...], seed: int = 42) -> DataFrame:
    """Add the scores of the two trained models beside the statistical ``score``.

    Both learn from normal training rows; ``scored`` is a table with ``split`` and ``label``. Scores are rounded to nine places, so that rows
    that are alike in all features tie whatever order their parts were added in.
    """
    normal = scored.where((F.col("split") == "train") & (F.col("label") == rules.NORMAL))
    rows = isolation_forest_score(scored, isolation_forest_fit(normal, features, seed=seed), features)
    rows = one_class_score(rows, one_class_fit(normal, features, seed=seed))
    return rows.withColumns({c: F.round(c, SCORE_DIGITS) for c in ("iforest_score", "one_class_score")})
