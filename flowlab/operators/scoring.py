"""Enrichment and summaries of scored flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Decision threshold and border of a high-confidence attack.
THRESHOLD = 0.5
HIGH_CONFIDENCE = 0.8
RESPONSE_ROWS = 100


def enrich(
    df: DataFrame, prob: str = "attack_probability", threshold: float = THRESHOLD,
    high: float = HIGH_CONFIDENCE,
) -> DataFrame:
    """Prediction, its text, confidence and the high-confidence flag from the attack probability."""
    p = F.col(prob)
    hit = p >= F.lit(threshold)
    scored = df if prob == "attack_probability" else df.withColumn("attack_probability", p)
    return scored.withColumns({
        "prediction": F.when(hit, 1).otherwise(0),
        "prediction_label": F.when(hit, "attack").otherwise("benign"),
        "confidence": F.greatest(p, F.lit(1.0) - p),
        "high_confidence_attack": F.coalesce(hit & (p >= F.lit(high)), F.lit(False)),
    })


def batch_summary(
    pred: DataFrame, high: float = HIGH_CONFIDENCE, prediction: str = "prediction",
    prob: str = "attack_probability",
) -> DataFrame:
    """One row of totals; safe on an empty table."""
    attack, p = F.col(prediction) == 1, F.col(prob)
    total, attacks = F.count("*"), F.count_if(attack)
    zero = F.lit(0.0)
    return pred.agg(
        total.alias("total_flows"),
        attacks.alias("attacks_detected"),
        F.count_if(F.col(prediction) == 0).alias("benign_flows"),
        F.round(F.when(total > 0, attacks * 100.0 / total).otherwise(zero), 2).alias("attack_rate_percent"),
        F.count_if(attack & (p >= high)).alias("high_confidence_attacks"),
        F.round(F.coalesce(F.avg(F.when(attack, p)), zero), 4).alias("avg_attack_probability"),
        F.round(F.coalesce(F.max(p), zero), 4).alias("max_attack_probability"),
    )


def batch_totals(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Totals of a batch response."""
    return batch_summary(pred.withColumn("attack_probability", F.lit(0.0)), prediction=prediction).select(
        "total_flows", "attacks_detected", F.col("attack_rate_percent").alias("attack_percentage"))


def batch_response(
    pred: DataFrame, key: str, limit: int = RESPONSE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Totals over all rows, and the first rows by key as shown to a caller."""
    shown = pred.orderBy(key).limit(limit).select(
        key, "prediction", "prediction_label", "attack_probability", "confidence")
    return batch_totals(pred), shown
