"""Continuous scoring, its totals and the alert feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlab.models.base import FlowModel, predict
from flowlab.sources.readers import CORRUPT
from flowlab.streaming.sources import start

Scorer = FlowModel | Callable[[DataFrame], DataFrame]


def score_stream(stream: DataFrame, model: Scorer, threshold: float = 0.5) -> DataFrame:
    """Scored and enriched stream; ``model`` is a fitted model or a function that scores a frame."""
    return predict(stream, model, threshold) if isinstance(model, FlowModel) else model(stream)


def stream_score(
    stream: DataFrame, model: Scorer, out: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """Score arriving flows into a Parquet folder, each flow exactly once."""
    scored = score_stream(stream, model)
    writer = scored.writeStream.format("parquet").option("path", out).outputMode("append")
    return start(writer, checkpoint, continuous=continuous)


def stream_summary(scored: DataFrame) -> DataFrame:
    """Running totals: flows, parsed, failed, attacks, attack rate over all flows.

    A stream of this has one row and is written in complete mode; state is that one row.
    """
    failed = F.col(CORRUPT).isNotNull() if CORRUPT in scored.columns else F.lit(False)
    total, attacks = F.count("*"), F.count_if(~failed & (F.col("prediction") == 1))
    return scored.groupBy().agg(
        total.alias("total_flows"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"),
        attacks.alias("attacks_detected"),
        F.round(F.when(total > 0, attacks * 100.0 / total).otherwise(F.lit(0.0)), 2).alias("attack_rate_pct"))


def alert_stream(scored: DataFrame, ts: str = "flow_ts", key: str = "flow_id") -> DataFrame:
    """Predicted attacks only: time, probability, confidence. No state."""
    return scored.filter(F.col("prediction") == 1).select(key, ts, "attack_probability", "confidence")


def run_stream_summary(scored: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest totals in a one-row Parquet table."""

    def replace(batch: DataFrame, _: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(out)

    return start(stream_summary(scored).writeStream.outputMode("complete").foreachBatch(replace), checkpoint)
