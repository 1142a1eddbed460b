"""Stateful streams: deduplication and per-source context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlab.operators.windows import HOUR_SECONDS, source_context
from flowlab.session import remove_path
from flowlab.streaming.sources import start


def stream_dedup(df: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """One row per key, repeats within the delay dropped; a table drops all repeats."""
    if not df.isStreaming:
        return df.dropDuplicates([key])
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_source_context(
    stream: DataFrame,
    ts: str,
    by: str,
    key: str,
    out: str,
    state: str,
    checkpoint: str,
    pkts: str = "tot_fwd_pkts",
    seconds: int = HOUR_SECONDS,
    ttl_seconds: int = 24 * HOUR_SECONDS,
    delay_seconds: int = 0,
    continuous: str | None = None,
) -> StreamingQuery:
    """Add the context of each flow's source as flows arrive.

    Each micro-batch runs the batch operator over the new rows and the rows still in reach,
    which are kept as one small table per batch in ``state``: the rows of the trailing window, and
    of older rows only the last per source. So a hot source is spread over tasks as in batch, and
    a batch repeated after a failure reads the same state and overwrites its own output. Rows
    older than the newest seen by more than the delay are dropped as late.
    """
    keep = [key, by, ts, pkts]

    def newest_of(rows: DataFrame) -> int | None:
        return rows.agg(F.unix_micros(F.max(ts))).first()[0]

    def ago(newest: int, back: int):
        return F.timestamp_micros(F.lit(newest - back * 1_000_000))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("__new", F.lit(True))
        if batch_id:
            held = spark.read.parquet(f"{state}/{batch_id - 1}")
            newest = newest_of(held)
            if newest is not None:
                new = new.filter(F.col(ts) >= ago(newest, delay_seconds))
            new = new.unionByName(held.withColumn("__new", F.lit(False)), allowMissingColumns=True)
        rows = new.persist()
        context = source_context(rows, ts, by, key, pkts, seconds, ttl_seconds)
        context.filter("__new").drop("__new").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        newest = newest_of(rows)
        tail = rows.select(*keep)
        if newest is not None:
            window = ago(newest, seconds + delay_seconds)
            alive = tail.filter((F.col(ts) < window) & (F.col(ts) >= ago(newest, ttl_seconds + delay_seconds)))
            last = alive.groupBy(by).agg(F.max(F.struct(ts, key, pkts)).alias("__last")).select(
                f"__last.{key}", by, f"__last.{ts}", f"__last.{pkts}")
            tail = tail.filter(F.col(ts) >= window).unionByName(last)
        tail.write.mode("overwrite").parquet(f"{state}/{batch_id}")
        rows.unpersist()
        if batch_id > 1:
            remove_path(spark, f"{state}/{batch_id - 2}")

    return start(stream.writeStream.foreachBatch(step), checkpoint, continuous=continuous)
