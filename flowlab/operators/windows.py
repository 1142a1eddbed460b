"""Sliding-window features and per-source context over flow tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.operators.running import fit_cuts, running_sums

# Default window, slide and lifetime of a source's context.
SIZE = "1 hour"
SLIDE = "30 minutes"
HOUR_SECONDS = 3600


def default_measures(duration: str = "flow_duration", fwd: str = "tot_fwd_pkts",
                     bwd: str = "tot_bwd_pkts", syn: str = "syn_flag_cnt") -> dict[str, Column]:
    """Window aggregates; all combine map-side, in batch and stream."""
    return {
        "n_flows": F.count("*"),
        "fwd_pkts": F.sum(fwd),
        "bwd_pkts": F.sum(bwd),
        "syn_flags": F.sum(syn),
        "max_duration": F.max(duration),
        "mean_duration": F.avg(duration),
    }


def windowed_features(
    df: DataFrame,
    ts: str,
    by: Sequence[str],
    size: str = SIZE,
    slide: str | None = SLIDE,
    delay: str | None = None,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Aggregates per key and event-time window; tumbling without ``slide``.

    The same text serves tables and streams. On a stream ``delay`` sets the watermark, and a
    window comes out once the watermark has passed its end.
    """
    if df.isStreaming and delay:
        df = df.withWatermark(ts, delay)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    aggs = [c.alias(n) for n, c in (measures or default_measures()).items()]
    return df.groupBy(window.alias("w"), *by).agg(*aggs).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *by, *(measures or default_measures()))


def trailing_sums(
    df: DataFrame,
    ts: str,
    by: Sequence[str],
    sums: Mapping[str, Column],
    seconds: int = HOUR_SECONDS,
    rows_per_slice: int | None = None,
    previous: str | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Per row, sums over the rows of the same key in the trailing window, both ends included.

    A range frame recomputes its rows for every output row. Here each row enters the running sum
    at its time and leaves it again after the window, so the work is linear, and the running
    sum is cut into slices, so a hot key is spread over tasks. Sums must be integer or decimal,
    where taking back is exact. ``previous`` names an extra column for the microseconds of the
    row before, found in the same pass, with ``tie`` ordering rows of one instant.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    row = F.struct(*df.columns)
    values = {f"__v_{n}": c for n, c in sums.items()}
    rank = F.col(tie) if tie else F.lit(0)
    enter = F.struct(micros.alias("__t"), F.lit(0).alias("__kind"), rank.alias("__tie"), row.alias("__row"),
                     *[v.alias(n) for n, v in values.items()])
    leave = F.struct((micros + F.lit(seconds * 1_000_000)).alias("__t"), F.lit(1).alias("__kind"),
                     rank.alias("__tie"), F.when(F.lit(False), row).alias("__row"),
                     *[(-v).alias(n) for n, v in values.items()])
    steps = df.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.inline(F.array(enter, leave)))
    cuts = fit_cuts(df, ts, rows_per_slice)
    entered = F.when(F.col("__kind") == 0, F.col("__t"))
    run = running_sums(
        steps, ["__t", "__kind"], {n: F.col(f"__v_{n}") for n in sums}, by=[f"__by_{c}" for c in by], cuts=cuts,
        largest_before={previous: entered} if previous else None, tie=["__tie"])
    return run.filter(F.col("__kind") == 0).select("__row.*", *sums, *([previous] if previous else []))


def source_context(
    df: DataFrame,
    ts: str,
    by: str,
    key: str,
    pkts: str = "tot_fwd_pkts",
    seconds: int = HOUR_SECONDS,
    ttl_seconds: int | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Per flow: gap to the source's previous flow, flows and packets in the trailing window.

    A gap longer than the lifetime ``ttl_seconds`` counts as no previous flow.
    """
    recent = trailing_sums(df, ts, [by], {
        "recent_flows": F.lit(1).cast("bigint"), "recent_pkts": F.col(pkts).cast("bigint")},
        seconds, rows_per_slice, "__previous", key)
    gap = (F.unix_micros(F.col(ts).cast("timestamp")) - F.col("__previous")) / F.lit(1e6)
    if ttl_seconds is not None:
        gap = F.when(gap <= ttl_seconds, gap)
    return recent.withColumn("gap_s", gap).drop("__previous")
