"""Class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators.joins import attach_class_value


def class_weights(df: DataFrame, label: str = "is_attack", out: str = "weight") -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    classes = Window.partitionBy(F.lit(0))
    total, k = F.sum("n").over(classes), F.count("*").over(classes)
    return counts.select(label, "n", (total / (k * F.col("n"))).alias(out))


def pos_weight(df: DataFrame, label: str = "is_attack") -> DataFrame:
    """Counts of both classes and negatives per positive (null without positives)."""
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(n0.alias("n_negative"), n1.alias("n_positive"),
                  F.when(n1 > 0, n0 / n1).alias("pos_weight"))


def with_pos_weight(df: DataFrame, label: str = "is_attack", out: str = "weight") -> DataFrame:
    """Row weight: negatives per positive on positive rows, 1 on the rest."""
    ratio = pos_weight(df, label).first()["pos_weight"] or 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def with_sample_weight(df: DataFrame, label: str = "is_attack", out: str = "weight") -> DataFrame:
    """Balanced class weight on every row."""
    return attach_class_value(df, class_weights(df, label, out).select(label, out), label)
