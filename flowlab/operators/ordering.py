"""Sorting, top-k, previous-row differences and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators.running import fit_cuts, order_value, previous_value

# Model families and balancing strategies in run names such as LR_SMOTE.
FAMILIES = ("LR", "RF", "XGB", "LGB", "SVM", "MLP", "NB")
STRATEGIES = ("SMOTE", "Weighted")


def time_ordered_head(df: DataFrame, ts: str, key: str, n: int | None = None) -> DataFrame:
    """All rows in time order, or the first ``n`` (a top-k, not a full sort)."""
    ordered = df.orderBy(ts, key)
    return ordered.limit(n) if n else ordered


def top_k(df: DataFrame, by: str, k: int, key: str) -> DataFrame:
    """The ``k`` rows with the largest value, ties by key."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(key)).limit(k)


def with_gap(
    df: DataFrame, ts: str, by: str, key: str, out: str = "gap_s", rows_per_slice: int | None = None
) -> DataFrame:
    """Seconds since the previous row of the same ``by`` value; null on its first row."""
    cuts = fit_cuts(df, ts, rows_per_slice)
    prev = previous_value(df, ts, key, [by], "__prev_ts", cuts)
    gap = (order_value(prev, ts) - order_value(prev, "__prev_ts")) / F.lit(1e6)
    return prev.select(*df.columns, gap.alias(out))


def best_by(df: DataFrame, metric: str, name: str = "run") -> DataFrame:
    """Name and value of the row with the largest metric, ties to the smallest name."""
    best = df.filter(F.col(metric).isNotNull() & ~F.isnan(metric)).agg(
        F.min_by(F.struct(name, metric), F.struct(-F.col(metric), F.col(name))).alias("best"))
    return best.filter(F.col("best").isNotNull()).select(
        F.lit(metric).alias("criterion"), F.col(f"best.{name}").alias(name),
        F.col(f"best.{metric}").alias("value"))


def metric_pivot(
    leaderboard: DataFrame, metric: str, strategies: Sequence[str] = STRATEGIES
) -> DataFrame:
    """One row per family, one column per strategy."""
    return leaderboard.groupBy("family").pivot("strategy", list(strategies)).agg(F.first(metric))


def parse_run_name(df: DataFrame, name: str = "run") -> DataFrame:
    """Family and strategy out of the run name, in any letter case; null where absent."""
    families, strategies = "|".join(FAMILIES), "|".join(STRATEGIES)
    family = F.upper(F.regexp_extract(F.col(name), f"(?i)^({families})_", 1))
    found = F.lower(F.regexp_extract(F.col(name), f"(?i)_({strategies})", 1))
    strategy = F.lit(None).cast("string")
    for s in STRATEGIES:
        strategy = F.when(found == s.lower(), s).otherwise(strategy)
    return df.withColumns({"family": F.nullif(family, F.lit("")), "strategy": strategy})


def metrics_to_rows(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """A small driver-side ``{run: {metric: value}}`` as one row per run."""
    names = sorted({m for values in metrics.values() for m in values})
    rows = [(run, *[None if values.get(m) is None else float(values[m]) for m in names])
            for run, values in metrics.items()]
    return spark.createDataFrame(rows, "run string, " + ", ".join(f"`{m}` double" for m in names))


def metrics_long(df: DataFrame, name: str, metrics: Sequence[str]) -> DataFrame:
    """One row per (run, metric)."""
    return df.unpivot([name], list(metrics), "metric", "value")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
