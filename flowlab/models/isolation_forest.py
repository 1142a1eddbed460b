"""Isolation forest (Liu, Ting and Zhou 2008) as Spark jobs.

Rows are drawn by key hash, so the forest does not depend on the partitioning. Each tree is built
from at most ``psi`` rows in its own group; the finished forest has at most ``trees * 2 * psi``
nodes, is broadcast, and scores Arrow batches by vectorised descent.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.functions import hash_uniform
from flowlab.operators.quantiles import exact_quantiles
from flowlab.operators.vectors import Scaler, feature_array
from flowlab.session import drop_folder, fresh_folder

# Default forest size, rows per tree and share of anomalies.
TREES = 100
PSI = 256
CONTAMINATION = 0.1
SEED = 42

EULER = 0.5772156649015329
OVERDRAW = 1.3
NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, path double"


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def draw_rows(
    df: DataFrame, n: int, key: str, x: Column, trees: int, psi: int, seed: int
) -> DataFrame:
    """Up to ``psi`` of the ``n`` rows per tree without replacement: (tree, k, x).

    Every tree draws from the whole table: a row is offered to each tree with a probability that leaves the tree somewhat
    more than ``psi`` rows. One hash per row gives the first tree it is offered to (that number is geometric), if any;
    only rows that have one, few in a large table, get a hash for each later tree. All others go before the shuffle.
    """
    rows = df.select(F.col(key).alias("k"), x.alias("x"))
    share = min(1.0, (OVERDRAW * psi + 12 * math.sqrt(psi)) / n)
    if share == 1.0:
        offered = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    else:
        first = F.floor(F.log1p(-hash_uniform(F.lit(seed + 1), F.col("k"))) / F.lit(math.log1p(-share)))
        later = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: (tree > F.col("first")) & (
            hash_uniform(F.lit(seed + 1), tree, F.col("k")) < share))
        offered = rows.withColumn("first", first).filter(F.col("first") < trees).withColumn(
            "tree", F.explode(F.concat(F.array(F.col("first").cast("int")), later)))
    offered = offered.withColumn("u", hash_uniform(F.lit(seed + 2), F.col("tree"), F.col("k")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("u", "k"))
    return offered.withColumn("rank", rank).filter(F.col("rank") <= psi).select("tree", "k", "x")


def _grow(tree: int, x: np.ndarray, depth: int, seed: int) -> pd.DataFrame:
    """Nodes of one tree; a leaf has feature -1 and carries its path length."""
    rng = np.random.default_rng([seed, tree])
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    count = 1
    while todo:
        node, rows, level = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if level >= depth or len(rows) <= 1 or not len(open_features):
            nodes.append((tree, node, -1, 0.0, node, node, level + mean_path(len(rows))))
            continue
        f = int(rng.choice(open_features))
        split = float(rng.uniform(low[f], high[f]))
        goes_left = x[rows, f] <= split
        nodes.append((tree, node, f, split, count, count + 1, 0.0))
        todo += [(count, rows[goes_left], level + 1), (count + 1, rows[~goes_left], level + 1)]
        count += 2
    return pd.DataFrame(sorted(nodes, key=lambda t: t[1]),
                        columns=["tree", "node", "feature", "split", "left", "right", "path"])


@dataclass
class IsolationForest:
    """Node table, row count per tree, decision offset and the features it reads."""

    nodes: pd.DataFrame
    features: list[str]
    psi: int
    offset: float = 0.5
    scaler: dict = field(default_factory=dict)
    meta: dict = field(default_factory=lambda: {"model_type": "IsolationForest"})

    def _packed(self) -> tuple:
        """The forest as flat arrays with absolute child positions."""
        t = self.nodes.sort_values(["tree", "node"])
        sizes = t.groupby("tree").size()
        starts = (sizes.cumsum() - sizes).to_numpy()
        base = np.repeat(starts, sizes.to_numpy())
        return (starts, t["feature"].to_numpy(), t["split"].to_numpy(), t["left"].to_numpy() + base,
                t["right"].to_numpy() + base, t["path"].to_numpy())

    def score(self, df: DataFrame, out: str = "anomaly") -> DataFrame:
        """Add the anomaly measure in (0, 1]; larger is more anomalous."""
        packed = df.sparkSession.sparkContext.broadcast(self._packed())
        norm = mean_path(self.psi) or 1.0

        @F.pandas_udf("double")
        def anomaly(rows: pd.Series) -> pd.Series:
            starts, feature, split, left, right, path = packed.value
            if not len(rows):
                return pd.Series([], dtype="float64")
            x = np.stack(rows.to_numpy())
            each = np.arange(len(x))
            total = np.zeros(len(x))
            for start in starts:
                at = np.full(len(x), start)
                while (feature[at] >= 0).any():
                    f = feature[at]
                    down = np.where(x[each, np.maximum(f, 0)] <= split[at], left[at], right[at])
                    at = np.where(f >= 0, down, at)
                total += path[at]
            return pd.Series(np.power(2.0, -(total / len(starts)) / norm))

        return df.withColumn(out, anomaly(feature_array(df, self.features, self.scaler)))


def fit_isolation_forest(
    df: DataFrame, key: str, features: Sequence[str], trees: int = TREES, psi: int = PSI,
    contamination: float = CONTAMINATION, seed: int = SEED, scaler: Scaler | None = None,
) -> IsolationForest:
    """Fit the forest and set the offset so that ``contamination`` of the rows lies above it."""
    x = feature_array(df, features, scaler)
    n = df.count()
    if n == 0:
        raise ValueError("no rows to fit an isolation forest on")
    psi = min(psi, n)
    drawn = draw_rows(df, n, key, x, trees, psi, seed)
    depth = math.ceil(math.log2(max(psi, 2)))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        return _grow(int(group["tree"].iloc[0]), np.stack(group["x"].to_numpy()), depth, seed)

    nodes = drawn.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
    forest = IsolationForest(nodes, list(features), psi, scaler=dict(scaler or {}))
    spark = df.sparkSession
    path = fresh_folder(spark, "anomaly")
    forest.score(df).select("anomaly").write.parquet(path)
    scores = spark.read.parquet(path)
    forest.offset = exact_quantiles(scores, {"anomaly": [1.0 - contamination]})["anomaly"][0] or 0.5
    drop_folder(spark, path)
    return forest


def score_isolation_forest(df: DataFrame, forest: IsolationForest) -> DataFrame:
    """Anomaly score relative to the offset (above 0 is an attack) and the 0/1 prediction."""
    above = F.col("__anomaly") - F.lit(forest.offset)
    return forest.score(df, "__anomaly").select(
        *df.columns, above.alias("anomaly_score"), F.when(above > 0, 1).otherwise(0).alias("prediction"))


def save_forest(spark: SparkSession, forest: IsolationForest, path: str) -> None:
    spark.createDataFrame(forest.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    row = (forest.features, forest.psi, forest.offset, {k: list(v) for k, v in forest.scaler.items()})
    spark.createDataFrame([row], "features array<string>, psi int, offset double, scaler map<string,array<double>>"
                          ).coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")


def load_forest(spark: SparkSession, path: str) -> IsolationForest:
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    row = spark.read.parquet(f"{path}/forest").first()
    return IsolationForest(nodes, list(row["features"]), row["psi"], row["offset"],
                           {k: tuple(v) for k, v in row["scaler"].items()})
