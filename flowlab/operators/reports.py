"""Comparison of runs: leaderboard, means, recommendation, best model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.operators.ordering import best_by, parse_run_name

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")

# Lead one strategy needs over the other, and the criteria of the final ranking.
STRATEGY_MARGIN = 0.02
CRITERIA = ("pr_auc", "f1", "recall")


def leaderboard(runs: DataFrame, metric: str = "pr_auc", name: str = "run") -> DataFrame:
    """Runs with family and strategy, best first."""
    return parse_run_name(runs, name).orderBy(F.col(metric).desc_nulls_last(), F.col(name))


def mean_by(board: DataFrame, group: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean of each metric per strategy or family."""
    return (board.filter(F.col(group).isNotNull()).groupBy(group)
            .agg(*[F.avg(m).alias(m) for m in metrics]))


def best_family(board: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """Family with the best mean metric."""
    return best_by(mean_by(board, "family", [metric]), metric, "family")


def recommend_strategy(
    board: DataFrame, metric: str = "pr_auc", margin: float = STRATEGY_MARGIN
) -> DataFrame:
    """Mean per strategy, and the one that leads by more than the margin, if any."""
    lead = F.lit(1 + margin)
    means = board.agg(
        F.avg(F.when(F.col("strategy") == "SMOTE", F.col(metric))).alias("smote_avg"),
        F.avg(F.when(F.col("strategy") == "Weighted", F.col(metric))).alias("weighted_avg"))
    return means.withColumn(
        "recommendation",
        F.when(F.col("weighted_avg") > F.col("smote_avg") * lead, "Weighted")
        .when(F.col("smote_avg") > F.col("weighted_avg") * lead, "SMOTE")
        .otherwise("similar"))


def better_strategy(board: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """Per family, SMOTE if it beats class weights, else Weighted."""
    best = {s: F.max(F.when(F.col("strategy") == s, F.col(metric))) for s in ("SMOTE", "Weighted")}
    return board.filter(F.col("family").isNotNull()).groupBy("family").agg(
        best["SMOTE"].alias("smote"), best["Weighted"].alias("weighted"),
    ).withColumn("better", F.when(F.col("smote") > F.col("weighted"), "SMOTE").otherwise("Weighted"))


def select_best(board: DataFrame, metric: str = "pr_auc", name: str = "run") -> DataFrame:
    """The run with the highest metric."""
    return best_by(board, metric, name)


def ranking(board: DataFrame, criteria: Sequence[str] = CRITERIA, name: str = "run") -> DataFrame:
    """Best run by each criterion, in one scan."""
    picks = []
    for m in criteria:
        best = F.min_by(F.struct(name, m), F.struct(-F.col(m), F.col(name)))
        picks.append(F.struct(F.lit(m).alias("criterion"), best[name].alias(name), best[m].alias("value")))
    return board.agg(F.array(*picks).alias("rows")).select(F.inline("rows"))
