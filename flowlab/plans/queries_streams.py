"""Queries that run a stream to its end and return what it wrote, checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators import scoring, windows
from flowlab.plans.catalog import query
from flowlab.plans.flows import flows, flows_from, with_flows, with_scored
from flowlab.plans.queries_metrics import scored
from flowlab.session import fresh_folder
from flowlab.sources.writers import write_parquet
from flowlab.streaming import (
    alert_stream,
    json_stream,
    parquet_stream,
    run_keyed_context,
    run_source_context,
    run_stream_summary,
    start,
    stream_dedup,
    stream_score,
    stream_summary,
    unzoned,
)


def flow_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return flows_from(parquet_stream(spark, f"{path}*", spark.read.parquet(path).schema))


def by_packets(df: DataFrame) -> DataFrame:
    """A fixed score, so that the stream's rows can be checked one by one."""
    return scoring.enrich(df.withColumn("attack_probability", F.col("tot_fwd_pkts") / F.lit(100.0)))


def drain(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run an append stream to its end; the table it wrote."""
    out = fresh_folder(spark, name)
    writer = df.writeStream.format("parquet").option("path", out).outputMode("append")
    start(writer, f"{out}-progress").awaitTermination()
    return unzoned(spark.read.schema(df.schema).parquet(out))


SCORED_ALL = """WITH s AS (SELECT flow_id, flow_ts, tot_fwd_pkts / 100e0 AS p FROM flows)"""


@query("g5_stream_score", with_flows(f"""{SCORED_ALL}
SELECT flow_id, flow_ts, p AS attack_probability, CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS prediction,
  greatest(p, 1e0 - p) AS confidence, p >= 0.8e0 AS high_confidence_attack FROM s"""))
def stream_scores(spark, sf_dir):
    out = fresh_folder(spark, "scores")
    stream = flow_stream(spark, sf_dir)
    stream_score(stream, by_packets, out, f"{out}-progress").awaitTermination()
    return unzoned(spark.read.parquet(out)).select(
        "flow_id", "flow_ts", "attack_probability", "prediction", "confidence", "high_confidence_attack")


@query("g6_stream_summary", with_flows("""
WITH s AS (SELECT flow_id % 50 = 7 AS broken, tot_fwd_pkts >= 50 AS attack FROM flows)
SELECT count(*) AS total_flows, count(*) FILTER (NOT broken) AS ok, count(*) FILTER (broken) AS failed,
  count(*) FILTER (NOT broken AND attack) AS attacks_detected,
  round(count(*) FILTER (NOT broken AND attack) * 100e0 / count(*), 2) AS attack_rate_pct FROM s"""))
def stream_totals(spark, sf_dir):
    """JSON flow records, every fiftieth cut short, through a stream."""
    df = flows(spark, sf_dir).select("flow_id", "tot_fwd_pkts")
    text = F.to_json(F.struct("flow_id", "tot_fwd_pkts"))
    broken = F.when(F.col("flow_id") % 50 == 7, F.substring(text, 1, 12)).otherwise(text)
    src = fresh_folder(spark, "records")
    df.select(broken.alias("value")).write.text(src)
    out = fresh_folder(spark, "totals")
    stream = by_packets(json_stream(spark, src, df.schema))
    run_stream_summary(stream, out, f"{out}-progress").awaitTermination()
    return spark.read.parquet(out)


@query("g7_alert_stream", with_flows(f"""{SCORED_ALL}
SELECT flow_id, flow_ts, p AS attack_probability, greatest(p, 1e0 - p) AS confidence FROM s WHERE p >= 0.5e0"""))
def alerts(spark, sf_dir):
    return drain(spark, alert_stream(by_packets(flow_stream(spark, sf_dir))), "alerts")


WINDOW_AGGS = """count(*) AS n_flows, CAST(sum(tot_fwd_pkts) AS BIGINT) AS fwd_pkts,
  CAST(sum(tot_bwd_pkts) AS BIGINT) AS bwd_pkts, CAST(sum(syn_flag_cnt) AS BIGINT) AS syn_flags,
  max(flow_duration) AS max_duration, round(avg(flow_duration), 4) AS mean_duration"""
SLIDING_SQL = f"""
WITH x AS (SELECT *, time_bucket(INTERVAL '30 minutes', flow_ts) - o * INTERVAL '30 minutes' AS window_start
  FROM flows, (VALUES (0), (1)) v(o)),
w AS (SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, src_id, {WINDOW_AGGS}
  FROM x GROUP BY 1, 2, 3)"""


@query("g8_windowed_features", with_flows(f"{SLIDING_SQL} SELECT * FROM w"))
def sliding_windows(spark, sf_dir):
    out = windows.windowed_features(flows(spark, sf_dir), "flow_ts", ["src_id"])
    return out.withColumn("mean_duration", F.round("mean_duration", 4))


@query("g8_tumbling_features", with_flows(f"""
SELECT time_bucket(INTERVAL '1 hour', flow_ts) AS window_start,
  time_bucket(INTERVAL '1 hour', flow_ts) + INTERVAL '1 hour' AS window_end, src_id, {WINDOW_AGGS}
FROM flows GROUP BY 1, 2, 3"""))
def tumbling_windows(spark, sf_dir):
    out = windows.windowed_features(flows(spark, sf_dir), "flow_ts", ["src_id"], slide=None)
    return out.withColumn("mean_duration", F.round("mean_duration", 4))


@query("g8_windowed_features_stream", with_flows(f"""{SLIDING_SQL}
SELECT w.* FROM w WHERE window_end <= (SELECT max(flow_ts) - INTERVAL '10 minutes' FROM flows)"""))
def sliding_windows_stream(spark, sf_dir):
    """Windows the watermark has closed."""
    out = windows.windowed_features(flow_stream(spark, sf_dir), "flow_ts", ["src_id"], delay="10 minutes")
    return drain(spark, out, "windows").withColumn("mean_duration", F.round("mean_duration", 4))


TRAILING_SQL = """count(*) OVER r AS recent_flows, CAST(sum(tot_fwd_pkts) OVER r AS BIGINT) AS recent_pkts"""
TRAILING_FRAME = """WINDOW r AS (PARTITION BY src_id ORDER BY flow_ts
  RANGE BETWEEN INTERVAL '1 hour' PRECEDING AND CURRENT ROW)"""


@query("g8_trailing_sums", with_flows(f"SELECT flow_id, {TRAILING_SQL} FROM flows {TRAILING_FRAME}"))
def trailing(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "flow_ts", "src_id", "tot_fwd_pkts")
    sums = {"recent_flows": F.lit(1).cast("bigint"), "recent_pkts": F.col("tot_fwd_pkts").cast("bigint")}
    return windows.trailing_sums(df, "flow_ts", ["src_id"], sums, rows_per_slice=max(1, df.count() // 10)).select(
        "flow_id", "recent_flows", "recent_pkts")


CONTEXT_SQL = f"""
WITH c AS (SELECT flow_id, src_id, {TRAILING_SQL}, (epoch_us(flow_ts) - epoch_us(lag(flow_ts)
    OVER (PARTITION BY src_id ORDER BY flow_ts, flow_id))) / 1e6 AS gap FROM flows {TRAILING_FRAME})
SELECT flow_id, src_id, recent_flows, recent_pkts, CASE WHEN gap <= 86400 THEN gap END AS gap_s FROM c"""
DAY = 86_400


@query("g9_source_context", with_flows(CONTEXT_SQL))
def context(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "src_id", "flow_ts", "tot_fwd_pkts")
    out = windows.source_context(df, "flow_ts", "src_id", "flow_id", ttl_seconds=DAY)
    return out.select("flow_id", "src_id", "recent_flows", "recent_pkts", "gap_s")


@query("g9_source_context_stream", with_flows(CONTEXT_SQL))
def context_stream(spark, sf_dir):
    """The flows arrive in four lots in time order, the query restarting from its checkpoint for
    each; the result equals the batch run."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src, out = fresh_folder(spark, "arrivals"), fresh_folder(spark, "context")
    for lot in range(4):
        arrived = events.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)) == lot)
        write_parquet(arrived, src, mode="append")
        stream = flows_from(parquet_stream(spark, src, events.schema)).select(
            "flow_id", "src_id", "flow_ts", "tot_fwd_pkts")
        run_source_context(stream, "flow_ts", "src_id", "flow_id", out, f"{out}-state", f"{out}-progress",
                           ttl_seconds=DAY).awaitTermination()
    return spark.read.parquet(out).select(
        "flow_id", "src_id", "recent_flows", "recent_pkts", "gap_s")


@query("g9_source_context_keyed", with_flows(CONTEXT_SQL))
def context_keyed(spark, sf_dir):
    """As above, from keyed state instead of a table of state."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src, out = fresh_folder(spark, "arrivals"), fresh_folder(spark, "context")
    for lot in range(4):
        arrived = events.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)) == lot)
        write_parquet(arrived, src, mode="append")
        stream = flows_from(parquet_stream(spark, src, events.schema)).select(
            "flow_id", "src_id", "flow_ts", "tot_fwd_pkts")
        run_keyed_context(stream, "flow_ts", "src_id", "flow_id", out, f"{out}-progress", ttl_seconds=DAY).awaitTermination()
    return spark.read.parquet(out).select("flow_id", "src_id", "recent_flows", "recent_pkts", "gap_s")


@query("g10_stream_dedup", with_flows("SELECT flow_id, flow_ts, src_id FROM flows"))
def dedup_stream(spark, sf_dir):
    """Each flow arrives twice and leaves once."""
    twice = flow_stream(spark, sf_dir).unionByName(flow_stream(spark, sf_dir)).select("flow_id", "flow_ts", "src_id")
    return drain(spark, stream_dedup(twice, "flow_id", "flow_ts", "40 days"), "unique")


@query("g6_summary_batch", with_scored("""
SELECT count(*) AS total_flows, count(*) AS ok, CAST(0 AS BIGINT) AS failed,
  count(*) FILTER (prediction = 1) AS attacks_detected,
  round(count(*) FILTER (prediction = 1) * 100e0 / count(*), 2) AS attack_rate_pct FROM scored"""))
def summary_batch(spark, sf_dir):
    return stream_summary(scored(spark, sf_dir))
