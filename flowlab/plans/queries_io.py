"""Queries through the sources and sinks: what was written reads back as it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.operators import profile, scoring, splitting
from flowlab.plans.catalog import query
from flowlab.plans.flows import flows, table, with_flows, with_labeled, with_scored
from flowlab.plans.queries_clean import TRAIN_END, VAL_END, labeled
from flowlab.plans.queries_metrics import scored
from flowlab.plans.queries_profile import SUMMARY_SQL
from flowlab.schema import CIC_SCHEMA
from flowlab.session import fresh_folder
from flowlab.sources import (
    combine,
    count_lines,
    from_json_flows,
    read_flows_csv,
    read_scoring_csv,
    read_table,
    slice_lines,
    to_json_flows,
    write_csv,
    write_json,
    write_parquet,
    write_splits,
)

CIC_FROM_FLOWS = {
    "Dst Port": "dst_port",
    "Timestamp": "date_format(flow_ts, 'yyyy-MM-dd HH:mm:ss')",
    "Flow Duration": "flow_duration",
    "Tot Fwd Pkts": "tot_fwd_pkts",
    "Tot Bwd Pkts": "tot_bwd_pkts",
    "TotLen Fwd Pkts": "totlen_fwd_pkts",
    "TotLen Bwd Pkts": "totlen_bwd_pkts",
    "Flow Byts/s": "flow_byts_s",
    "Flow IAT Mean": "flow_iat_mean",
    "Flow IAT Std": "flow_iat_std",
    "Pkt Len Mean": "pkt_len_mean",
    "Pkt Len Std": "pkt_len_std",
    "FIN Flag Cnt": "fin_flag_cnt",
    "SYN Flag Cnt": "syn_flag_cnt",
    "Fwd URG Flags": "fwd_urg_flags",
    "Bwd URG Flags": "bwd_urg_flags",
    "Init Fwd Win Byts": "cast(flow_id as int)",
    "Label": "label",
}


def cic_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows in the 80-column layout; columns without a source are null."""
    return flows(spark, sf_dir).select(*[
        F.expr(CIC_FROM_FLOWS.get(f.name, "null")).cast(f.dataType).alias(f.name) for f in CIC_SCHEMA.fields])


def _capture(spark: SparkSession, sf_dir: str) -> str:
    """Flows as CSV, and beside them lines that a capture broke off: every 97th flow's, without its time."""
    path = fresh_folder(spark, "capture")
    write_csv(cic_flows(spark, sf_dir), f"{path}/flows")
    broken = flows(spark, sf_dir).filter(F.col("flow_id") % 97 == 0)
    broken.select(F.concat_ws(",", "dst_port", F.lit("6"), F.lit("2024-01-"), "flow_id").alias("value")).write.text(f"{path}/broken")
    return f"{path}/*"


SLICE = ("2024-01-05 09:15:00", "2024-01-05 21:46:00")


@query("a10_slice_lines", with_flows(f"""
SELECT CAST(flow_id AS INT) AS flow_id, strftime(flow_ts, '%Y-%m-%d %H:%M:%S') AS flow_time, dst_port, label FROM flows
WHERE flow_ts >= TIMESTAMP '{SLICE[0]}' AND flow_ts < TIMESTAMP '{SLICE[1]}'"""))
def slice_of_lines(spark, sf_dir):
    """The lines of a capture that fall in a time range, parsed only then."""
    rows = slice_lines(spark, _capture(spark, sf_dir), *SLICE)
    return rows.select(F.col("Init Fwd Win Byts").alias("flow_id"), F.col("Timestamp").alias("flow_time"),
                       F.col("Dst Port").alias("dst_port"), F.col("Label").alias("label"))


@query("a10_count_lines", with_flows(f"""
SELECT CASE WHEN flow_ts >= TIMESTAMP '{SLICE[0]}' AND flow_ts < TIMESTAMP '{SLICE[1]}' THEN 'inside' ELSE 'outside' END AS kind,
  count(*) AS n FROM flows GROUP BY 1
UNION ALL SELECT 'bad', count(*) FROM flows WHERE flow_id % 97 = 0"""))
def count_of_lines(spark, sf_dir):
    """Lines of a capture by kind; headers are as many as files."""
    return count_lines(spark, _capture(spark, sf_dir), *SLICE).filter("kind <> 'header'")


@query("a1_read_flows_csv", with_flows("""
SELECT CAST(flow_id AS INT) AS flow_id, strftime(flow_ts, '%Y-%m-%d %H:%M:%S') AS flow_time, dst_port,
  flow_duration, tot_fwd_pkts, flow_byts_s, label FROM flows"""))
def read_csv(spark, sf_dir):
    path = fresh_folder(spark, "csv")
    write_csv(cic_flows(spark, sf_dir), path)
    return read_flows_csv(spark, path).select(
        F.col("Init Fwd Win Byts").alias("flow_id"), F.col("Timestamp").alias("flow_time"),
        F.col("Dst Port").alias("dst_port"), F.col("Flow Duration").alias("flow_duration"),
        F.col("Tot Fwd Pkts").alias("tot_fwd_pkts"), F.col("Flow Byts/s").alias("flow_byts_s"),
        F.col("Label").alias("label"))


_SET = {f.name: CIC_FROM_FLOWS.get(f.name) for f in CIC_SCHEMA.fields}


@query("a3_cic_schema", with_flows(" UNION ALL ".join(
    f"""SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS column_type, count(*) AS n_rows,
  count(*){'' if not _SET[f.name] else ' - count(label)' if f.name == 'Label' else
           ' - count(flow_byts_s)' if f.name == 'Flow Byts/s' else ' - count(*)'} AS n_null FROM flows"""
    for f in CIC_SCHEMA.fields)))
def cic_schema(spark, sf_dir):
    df = cic_flows(spark, sf_dir)
    types = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in CIC_SCHEMA.fields],
                                  "column_name string, column_type string")
    return profile.quality_report(df).select("column_name", "n_rows", "n_null").join(types, "column_name")


@query("a4_read_table", "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'")
def read_parquet(spark, sf_dir):
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_shipdate"])
    return lines.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))


@query("a5_read_scoring_csv", with_flows("""
SELECT CAST(flow_id AS VARCHAR) AS flow_id, tot_bwd_pkts * 1e0 AS tot_bwd_pkts, 0 AS not_there, flow_duration FROM flows"""))
def read_scoring(spark, sf_dir):
    path = fresh_folder(spark, "scoring")
    write_csv(flows(spark, sf_dir).select("label", "flow_duration", "flow_id", "tot_bwd_pkts"), path)
    return read_scoring_csv(spark, path, ["tot_bwd_pkts", "not_there", "flow_duration"], keep=["flow_id"])


@query("a7_write_parquet", with_flows("""
SELECT flow_id, flow_ts, label, CAST(flow_ts AS DATE) AS day FROM flows"""))
def parquet_round_trip(spark, sf_dir):
    path = fresh_folder(spark, "parquet")
    write_parquet(flows(spark, sf_dir).select("flow_id", "flow_ts", "label", F.to_date("flow_ts").alias("day")),
                  path, partition_by=["day"])
    return read_table(spark, path)


@query("a8_write_csv", with_scored("""
SELECT flow_id, attack_type, p AS attack_probability, prediction,
  CASE WHEN p >= 0.5e0 THEN 'attack' ELSE 'benign' END AS prediction_label FROM scored"""))
def csv_round_trip(spark, sf_dir):
    path = fresh_folder(spark, "predictions")
    out = scoring.enrich(scored(spark, sf_dir), "p").select(
        "flow_id", "attack_type", "attack_probability", "prediction", "prediction_label")
    write_csv(out, path, max_records_per_file=2_000_000)
    return read_flows_csv(spark, path, out.schema)


@query("a9_combine", with_flows("""
SELECT flow_id, label FROM flows WHERE label = 'Benign' UNION ALL SELECT flow_id, label FROM flows WHERE label = 'Bot'"""))
def combine_tables(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "label")
    return combine(df.filter("label = 'Benign'"), df.filter("label = 'Bot'"))


@query("a11_write_json", with_scored(SUMMARY_SQL))
def json_round_trip(spark, sf_dir):
    path = fresh_folder(spark, "summary")
    out = scoring.batch_summary(scoring.enrich(scored(spark, sf_dir), "p"))
    write_json(out, path)
    return spark.read.schema(out.schema).json(path)


@query("a12_json_flows", with_flows(
    "SELECT flow_id, dst_port, protocol, flow_duration, label FROM flows"))
def json_flows(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "dst_port", "protocol", "flow_duration", "label")
    return from_json_flows(to_json_flows(df), "json", T.StructType(df.schema.fields))


@query("a13_write_splits", with_labeled(f"""
SELECT flow_id, is_attack, flow_duration, CASE WHEN flow_ts < TIMESTAMP '{TRAIN_END}' THEN 'train'
  WHEN flow_ts < TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split FROM labeled"""))
def splits_round_trip(spark, sf_dir):
    path = fresh_folder(spark, "splits")
    marked = splitting.with_time_split(labeled(spark, sf_dir), "flow_ts", TRAIN_END, VAL_END)
    write_splits(marked.select("flow_id", "is_attack", "flow_duration", "split"), path)
    return read_table(spark, path)


@query("a4_count_tables", """
SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def count_tables(spark, sf_dir):
    parts = [table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n")
             for t in ("orders", "lineitem")]
    return combine(*parts)
