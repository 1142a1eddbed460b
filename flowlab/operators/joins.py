"""Keyed joins that replace row-position alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CLASS_ROWS = 10_000


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def join_labels(features: DataFrame, labels: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Inner join on the key; with ``check`` a repeated label key is an error."""
    if check and not duplicate_keys(labels, key).isEmpty():
        raise ValueError(f"{key} is not unique in the label table")
    return features.join(labels, key)


def attach_class_value(df: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Left join to a per-class table: broadcast if it proves small, else a plain join."""
    rows = table.limit(MAX_CLASS_ROWS + 1).collect()
    if len(rows) > MAX_CLASS_ROWS:
        return df.join(table, on, "left")
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, table.schema)), on, "left")


def join_truth(pred: DataFrame, truth: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Predictions with their true labels by key."""
    return join_labels(pred, truth, key, check)
