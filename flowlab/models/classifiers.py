"""Distributed fits of the attack classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions import hash_hex
from flowlab.models.base import VECTOR, FlowModel, with_vector
from flowlab.models.boosting import Growth, fit_boosted
from flowlab.operators.features import class_counts
from flowlab.operators.vectors import Scaler, feature_array

SEED = 42

# Default model sizes.
LOGISTIC_ITERATIONS = 1000
FOREST_TREES, FOREST_DEPTH = 100, 10
FOREST_ROWS, FOREST_PART_ROWS = 100_000, 1_000_000
BOOST_ROUNDS, BOOST_DEPTH, BOOST_RATE = 100, 6, 0.1
LEAFWISE_DEPTH, LEAFWISE_LEAVES, LEAFWISE_ROWS, LEAFWISE_WEIGHT = 10, 31, 20, 1e-3
SVM_ITERATIONS, SVM_FOLDS = 2000, 3
NB_SMOOTHING = 1e-9


def _training(
    df: DataFrame, features: Sequence[str], label: str, weight: str | None, scaler: Scaler | None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Only what a fit reads: vector, label as double, weight."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return with_vector(df, features, scaler).filter(F.col(label).isNotNull()).select(
        VECTOR, F.col(label).cast("double").alias("y"), w.alias("w"), *extra)


def _spread(rows: DataFrame) -> DataFrame:
    """Large tables in parts of equal size, of a fixed order, so that a seed draws the same rows again.

    A forest keeps its parts through all levels, and files may leave most rows in a few of them. Each part also sends its
    sums of every open node, so there are no more than the cores take at once, or than keep a part to ``FOREST_PART_ROWS``.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    if n <= FOREST_ROWS:
        return rows
    x = vector_to_array(VECTOR)
    return rows.repartition(cores * -(-n // (cores * FOREST_PART_ROWS))).sortWithinPartitions(F.xxhash64(x), x, "y", "w")


def _model(stages, features, scaler, kind, **extra) -> FlowModel:
    probability = extra.pop("probability", ["probability"])
    return FlowModel(PipelineModel(stages), list(features), dict(scaler or {}), probability,
                     {"model_type": kind, **extra})


def _penalty(train: DataFrame, c: float) -> float:
    """Spark averages the loss, so a penalty against the summed loss is divided by the rows."""
    total = train.agg(F.sum("w")).first()[0] or 1.0
    return 1.0 / (c * total)


def fit_logistic(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None,
    scaler: Scaler | None = None, max_iter: int = LOGISTIC_ITERATIONS, c: float = 1.0,
) -> FlowModel:
    """Logistic regression with an L2 penalty on the raw coefficients."""
    rows = _training(train, features, label, weight, scaler)
    fit = LogisticRegression(featuresCol=VECTOR, labelCol="y", weightCol="w", maxIter=max_iter,
                             regParam=_penalty(rows, c), standardization=False).fit(rows)
    return _model([fit], features, scaler, "LogisticRegression")


def fit_random_forest(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None,
    scaler: Scaler | None = None, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED,
) -> FlowModel:
    rows = _spread(_training(train, features, label, weight, scaler))
    fit = RandomForestClassifier(featuresCol=VECTOR, labelCol="y", weightCol="w", numTrees=trees,
                                 maxDepth=depth, seed=seed).fit(rows)
    return _model([fit], features, scaler, "RandomForest")


def fit_gbt(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None,
    scaler: Scaler | None = None, val: DataFrame | None = None, depth: int = BOOST_DEPTH,
    rate: float = BOOST_RATE, rounds: int = BOOST_ROUNDS, seed: int = SEED, kind: str = "GradientBoosting",
    **growth,
) -> FlowModel:
    """Second-order boosted trees, level by level; with ``val`` they end at the best round there.

    ``growth`` takes the other fields of ``boosting.Growth``: subsample, colsample, gamma, penalties, least weight.
    """
    chosen = Growth(rounds=rounds, depth=depth, rate=rate, seed=seed, **growth)
    return fit_boosted(train, features, chosen, label, weight, scaler, val, kind)


def fit_leafwise_gbt(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None,
    scaler: Scaler | None = None, val: DataFrame | None = None, depth: int = LEAFWISE_DEPTH,
    leaves: int = LEAFWISE_LEAVES, **options,
) -> FlowModel:
    """Boosted trees that split the open leaf with the largest gain, up to ``leaves`` leaves and ``depth`` levels."""
    chosen = {"reg_lambda": 0.0, "min_child_rows": LEAFWISE_ROWS, "min_child_weight": LEAFWISE_WEIGHT,
              "kind": "LeafwiseGradientBoosting", **options}
    return fit_gbt(train, features, label, weight, scaler, val, depth=depth, leaves=leaves, **chosen)


def fit_calibrated_svm(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None,
    scaler: Scaler | None = None, key: str = "flow_id", folds: int = SVM_FOLDS,
    max_iter: int = SVM_ITERATIONS, c: float = 1.0, seed: int = SEED,
) -> FlowModel:
    """Linear SVMs on hash folds, each calibrated by a sigmoid on its held-out fold; mean of all.

    The sigmoid is fitted to smoothed targets: a row enters twice, with its label and against
    it, weighted by the smoothed share.
    """
    fold = F.pmod(F.conv(F.substring(hash_hex(key, seed=seed), 1, 8), 16, 10).cast("bigint"), F.lit(folds))
    rows = _training(train.withColumn("__fold", fold), features, label, weight, scaler, ["__fold"]).cache()
    machines, slicers, sigmoids = [], [], []
    for i in range(folds):
        part, held = rows.filter(F.col("__fold") != i), rows.filter(F.col("__fold") == i)
        svm = LinearSVC(featuresCol=VECTOR, labelCol="y", weightCol="w", maxIter=max_iter,
                        regParam=_penalty(part, c), standardization=False,
                        rawPredictionCol=f"raw_{i}", predictionCol=f"side_{i}").fit(part)
        slicer = VectorSlicer(inputCol=f"raw_{i}", outputCol=f"margin_{i}", indices=[1])
        margins = slicer.transform(svm.transform(held)).select(f"margin_{i}", "y", "w")
        n = {y: k for y, k in class_counts(margins, "y").items()}
        high = (n.get(1.0, 0) + 1.0) / (n.get(1.0, 0) + 2.0)
        low = 1.0 / (n.get(0.0, 0) + 2.0)
        target = F.when(F.col("y") == 1, F.lit(high)).otherwise(F.lit(low))
        both = F.array(F.struct(F.lit(1.0).alias("t"), (F.col("w") * target).alias("v")),
                       F.struct(F.lit(0.0).alias("t"), (F.col("w") * (1 - target)).alias("v")))
        soft = margins.select(f"margin_{i}", F.inline(both))
        sigmoid = LogisticRegression(featuresCol=f"margin_{i}", labelCol="t", weightCol="v",
                                     rawPredictionCol=f"logit_{i}", probabilityCol=f"probability_{i}",
                                     predictionCol=f"class_{i}").fit(soft)
        machines.append(svm)
        slicers.append(slicer)
        sigmoids.append(sigmoid)
    rows.unpersist()
    stages = [s for trio in zip(machines, slicers, sigmoids, strict=True) for s in trio]
    return _model(stages, features, scaler, "CalibratedLinearSVM",
                  probability=[f"probability_{i}" for i in range(folds)])


def fit_gaussian_nb(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None,
    scaler: Scaler | None = None,
) -> FlowModel:
    rows = _training(train, features, label, weight, scaler)
    fit = NaiveBayes(featuresCol=VECTOR, labelCol="y", weightCol="w", modelType="gaussian",
                     smoothing=NB_SMOOTHING).fit(rows)
    return _model([fit], features, scaler, "GaussianNaiveBayes")


def gaussian_nb_parameters(
    train: DataFrame, features: Sequence[str], label: str = "is_attack", weight: str | None = None
) -> DataFrame:
    """Per class and feature: share of the class, weighted mean and population variance.

    Two scans: the variance is taken around the fitted means, which keeps its digits.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = train.filter(F.col(label).isNotNull()).select(
        F.col(label).alias("y"), w.alias("w"), feature_array(train, features).alias("x"))
    sums = [(F.sum(F.col("w") * F.col("x")[i]) / F.sum("w")).alias(f"m{i}") for i in range(len(features))]
    per_class = rows.groupBy("y").agg(F.sum("w").alias("w"), *sums).collect()
    total = sum(r["w"] for r in per_class)
    cells = []
    for i, name in enumerate(features):
        mean = F.lit(None).cast("double")
        for r in per_class:
            mean = F.when(F.col("y") == r["y"], F.lit(r[f"m{i}"])).otherwise(mean)
        off = F.col("x")[i] - mean
        cells.append(F.struct(F.lit(name).alias("feature"), F.first(mean).alias("mean"),
                              (F.sum(F.col("w") * off * off) / F.sum("w")).alias("variance")))
    classes = rows.groupBy("y").agg((F.sum("w") / F.lit(total)).alias("prior"), F.array(*cells).alias("cells"))
    return classes.select(F.col("y").alias(label), "prior", F.inline("cells"))
