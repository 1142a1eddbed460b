from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowlab import models
from flowlab.models.base import predict
from flowlab.operators import windows
from flowlab.session import fresh_folder
from flowlab.sources import write_parquet
from flowlab.streaming import (
    csv_stream,
    parquet_stream,
    run_keyed_context,
    run_source_context,
    start,
    stream_dedup,
    stream_score,
)

SCHEMA = "flow_id bigint, src_id bigint, s bigint, tot_fwd_pkts int, tot_bwd_pkts int, syn_flag_cnt int, flow_duration double"


def flow_rows(spark, n=600):
    """A third of the flows come from source 1."""
    i = F.col("id")
    return spark.range(n).select(
        i.alias("flow_id"), F.when(i % 3 == 0, 1).otherwise(i % 7).cast("bigint").alias("src_id"),
        F.timestamp_seconds(i * 60 + 1_704_067_200).alias("flow_ts"), (i % 50).cast("int").alias("tot_fwd_pkts"),
        (i % 13).cast("int").alias("tot_bwd_pkts"), (i % 4).cast("int").alias("syn_flag_cnt"),
        (i * 1.5).alias("flow_duration"))


def deliver(df, src):
    write_parquet(df.coalesce(1), src, mode="append")


def drain(spark, df, out, progress):
    start(df.writeStream.format("parquet").option("path", out), progress).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_windows_in_lots_equal_batch_and_late_rows_are_dropped(spark):
    rows = flow_rows(spark)
    src, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    for lot in range(3):
        deliver(rows.filter((F.col("flow_id") / 200).cast("int") == lot), src)
        stream = parquet_stream(spark, src, rows.schema)
        got = drain(spark, windows.windowed_features(stream, "flow_ts", ["src_id"], delay="10 minutes"), out, f"{out}-p")
    late = rows.filter("flow_id = 3")
    deliver(late, src)
    got = drain(spark, windows.windowed_features(
        parquet_stream(spark, src, rows.schema), "flow_ts", ["src_id"], delay="10 minutes"), out, f"{out}-p")
    border = rows.agg(F.max("flow_ts") - F.expr("interval 10 minutes")).first()[0]
    batch = windows.windowed_features(rows, "flow_ts", ["src_id"]).filter(F.col("window_end") <= F.lit(border))
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty() and batch.count() > 50


def test_context_in_lots_equals_batch(spark):
    rows = flow_rows(spark).select("flow_id", "src_id", "flow_ts", "tot_fwd_pkts")
    src, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    for lot in range(3):
        deliver(rows.filter((F.col("flow_id") / 200).cast("int") == lot), src)
        run_source_context(parquet_stream(spark, src, rows.schema), "flow_ts", "src_id", "flow_id", out,
                           f"{out}-s", f"{out}-p", ttl_seconds=7200).awaitTermination()
    batch = windows.source_context(rows, "flow_ts", "src_id", "flow_id", ttl_seconds=7200)
    got = spark.read.parquet(out).select(*batch.columns)
    assert got.exceptAll(batch).isEmpty() and got.count() == 600


@pytest.mark.parametrize("slices", [25, 1_000_000])
def test_trailing_sums_equal_a_range_frame(spark, slices):
    rows = flow_rows(spark).union(flow_rows(spark, 40))
    sums = {"n": F.lit(1).cast("bigint"), "pkts": F.col("tot_fwd_pkts").cast("bigint")}
    got = windows.trailing_sums(rows, "flow_ts", ["src_id"], sums, 1800, slices)
    rows.createOrReplaceTempView("trailing_rows")
    want = spark.sql("""SELECT *, count(*) OVER w AS n, sum(tot_fwd_pkts) OVER w AS pkts FROM trailing_rows
        WINDOW w AS (PARTITION BY src_id ORDER BY flow_ts RANGE BETWEEN INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW)""")
    assert got.exceptAll(want).isEmpty() and got.count() == 640


def test_dedup_across_lots(spark):
    rows = flow_rows(spark, 50)
    src, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    for _ in range(2):
        deliver(rows, src)
        got = drain(spark, stream_dedup(parquet_stream(spark, src, rows.schema), "flow_id", "flow_ts", "1 day"), out, f"{out}-p")
    assert got.count() == 50
    assert stream_dedup(rows.union(rows), "flow_id", "flow_ts").count() == 50


def test_model_scores_a_csv_stream_like_a_table(spark):
    rows = flow_rows(spark).drop("flow_ts").withColumn("is_attack", (F.col("tot_fwd_pkts") > 40).cast("int"))
    model = models.fit_gaussian_nb(rows, ["tot_fwd_pkts", "tot_bwd_pkts"])
    src, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    rows.write.option("header", True).csv(src)
    stream_score(csv_stream(spark, src, rows.schema, files_per_batch=1), model, out, f"{out}-p").awaitTermination()
    got, want = spark.read.parquet(out), predict(rows, model)
    assert got.count() == 600 and got.select(*want.columns).exceptAll(want).isEmpty()


@pytest.mark.parametrize("parts", [1, 3])
def test_keyed_context_in_lots_equals_batch(spark, parts):
    """A lot ends between two flows; equal times, a repeated flow, a flow without a time, and gaps past the lifetime."""
    rows = flow_rows(spark, 400).select("flow_id", "src_id", "flow_ts", "tot_fwd_pkts")
    later = rows.filter("flow_id >= 390").withColumn("flow_id", F.col("flow_id") + 1000).withColumn(
        "flow_ts", F.col("flow_ts") + F.expr("INTERVAL 5 HOURS"))
    same = rows.filter("flow_id % 50 = 1").withColumn("flow_id", F.col("flow_id") + 5000)
    rows = rows.union(same).union(rows.filter("flow_id = 7")).union(later)
    lots = [rows.filter("flow_id < 200 OR flow_id BETWEEN 5000 AND 5199"),
            rows.filter("flow_id BETWEEN 200 AND 999 OR flow_id >= 5200"), rows.filter("flow_id BETWEEN 1000 AND 4999")]
    src, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    for lot in lots:
        deliver(lot.union(lot.limit(1).withColumn("flow_ts", F.lit(None).cast("timestamp"))), src)
        run_keyed_context(parquet_stream(spark, src, rows.schema), "flow_ts", "src_id", "flow_id", out, f"{out}-p",
                          seconds=1800, ttl_seconds=7200, sub_keys=parts).awaitTermination()
    batch = windows.source_context(rows, "flow_ts", "src_id", "flow_id", seconds=1800, ttl_seconds=7200).withColumn(
        "tot_fwd_pkts", F.col("tot_fwd_pkts").cast("bigint"))
    got = spark.read.parquet(out).select(*batch.columns)
    assert got.exceptAll(batch).isEmpty() and got.count() == rows.count() == 419
    deliver(rows.filter("flow_id = 3"), src)
    run_keyed_context(parquet_stream(spark, src, rows.schema), "flow_ts", "src_id", "flow_id", out, f"{out}-p",
                      seconds=1800, ttl_seconds=7200, sub_keys=parts).awaitTermination()
    assert spark.read.parquet(out).count() == 419


def test_small_sources_share_keyed_state(spark):
    """Many sources in one bundle: few state rows; a source that fell silent keeps its history while others go on."""
    rows = flow_rows(spark, 400).select("flow_id", (F.col("flow_id") % 90).alias("src_id"), "flow_ts", "tot_fwd_pkts").withColumn(
        "src_id", F.when(F.col("flow_id") % 200 > 100, F.col("src_id") % 3).when(F.col("src_id") == 4, None).otherwise(F.col("src_id")))
    src, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    for lot in range(2):
        deliver(rows.filter((F.col("flow_id") / 200).cast("int") == lot), src)
        run = run_keyed_context(parquet_stream(spark, src, rows.schema), "flow_ts", "src_id", "flow_id", out, f"{out}-p",
                                seconds=7200, ttl_seconds=14_400, sub_keys=2, bundles=1)
        run.awaitTermination()
        assert 0 < max(s["numRowsTotal"] for p in run.recentProgress for s in p["stateOperators"]) < 90
    batch = windows.source_context(rows, "flow_ts", "src_id", "flow_id", seconds=7200, ttl_seconds=14_400).withColumn(
        "tot_fwd_pkts", F.col("tot_fwd_pkts").cast("bigint"))
    got = spark.read.parquet(out).select(*batch.columns)
    assert got.exceptAll(batch).isEmpty() and got.count() == 400
