"""Queries over the profiling, ordering and reshaping operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.operators import ordering, profile, scaling, scoring, splitting
from flowlab.plans.catalog import query
from flowlab.plans.flows import flows, table, with_flows, with_labeled, with_scored
from flowlab.plans.queries_clean import NUMERIC, SCALED, TRAIN_END, labeled
from flowlab.plans.queries_metrics import scored

QUALITY_COLS = ["flow_id", "flow_ts", "src_id", "dst_port", "src_port", "protocol", "flow_duration", "tot_fwd_pkts",
                "tot_bwd_pkts", "totlen_fwd_pkts", "totlen_bwd_pkts", "pkt_len_mean", "pkt_len_std", "flow_iat_mean",
                "flow_iat_std", "fin_flag_cnt", "syn_flag_cnt", "fwd_urg_flags", "bwd_urg_flags", "flow_byts_s",
                "delta_start", "label"]


def confident(spark, sf_dir):
    return scoring.enrich(scored(spark, sf_dir), "p")


CONFIDENT_SQL = """SELECT flow_id, flow_ts, p AS attack_probability, prediction, greatest(p, 1e0 - p) AS confidence
  FROM scored"""


@query("d1_quality_report", with_flows(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, 22 AS n_columns, count(*) - count({c}) AS n_null FROM flows"
    for c in QUALITY_COLS)))
def quality_report(spark, sf_dir):
    return profile.quality_report(flows(spark, sf_dir))


@query("d2_missing_percent", with_flows("""
SELECT 'flow_byts_s' AS column_name,
  round(count(*) FILTER (flow_byts_s IS NULL OR isnan(flow_byts_s)) * 100e0 / count(*), 6) AS missing_pct FROM flows
UNION ALL SELECT 'label', round(count(*) FILTER (label IS NULL) * 100e0 / count(*), 6) FROM flows"""))
def missing_percent(spark, sf_dir):
    return profile.missing_percent(flows(spark, sf_dir)).withColumn("missing_pct", F.round("missing_pct", 6))


@query("d3_label_distribution", with_flows("SELECT label, count(*) AS n FROM flows GROUP BY label"))
def label_distribution(spark, sf_dir):
    return profile.label_distribution(flows(spark, sf_dir), "label")


@query("d4_label_share", with_labeled("""
SELECT label, count(*) AS n, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS share_pct
FROM labeled GROUP BY label"""))
def label_share(spark, sf_dir):
    return profile.label_share(labeled(spark, sf_dir), "label").withColumn("share_pct", F.round("share_pct", 6))


@query("d5_imbalance_ratio", with_labeled("""
WITH c AS (SELECT count(*) AS n FROM labeled GROUP BY label)
SELECT max(n) AS n_largest, min(n) AS n_smallest, round(max(n) / CAST(min(n) AS DOUBLE), 6) AS imbalance_ratio FROM c"""))
def imbalance_ratio(spark, sf_dir):
    return profile.imbalance_ratio(labeled(spark, sf_dir), "label").withColumn(
        "imbalance_ratio", F.round("imbalance_ratio", 6))


CORR_COLS = ["flow_duration", "tot_fwd_pkts", "tot_bwd_pkts", "totlen_fwd_pkts", "totlen_bwd_pkts",
             "pkt_len_mean", "pkt_len_std", "flow_iat_mean"]


@query("d6_correlation_matrix", with_flows(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) + 0e0 AS corr FROM flows"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:])))
def correlation_matrix(spark, sf_dir):
    return profile.correlation_matrix(flows(spark, sf_dir), CORR_COLS).withColumn(
        "corr", F.round("corr", 6) + F.lit(0.0))


@query("d7_histogram_by_class", """
WITH l AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin
  FROM lineitem, l),
g AS (SELECT DISTINCT l_returnflag FROM lineitem),
k AS (SELECT l_returnflag, CAST(b AS INT) AS bin FROM g, range(50) r(b))
SELECT k.l_returnflag, k.bin, round(any_value(lo + k.bin * ((hi - lo) / 50)), 6) AS bin_start, count(c.bin) AS n
FROM k CROSS JOIN l LEFT JOIN c ON c.l_returnflag = k.l_returnflag AND c.bin = k.bin GROUP BY 1, 2""")
def histogram_by_class(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag").withColumn(
        "bin_start", F.round("bin_start", 6))


@query("d8_confidence_histogram", with_scored(f"""
WITH a AS (SELECT confidence FROM ({CONFIDENT_SQL}) s WHERE prediction = 1),
l AS (SELECT min(confidence) AS lo, max(confidence) AS hi FROM a)
SELECT CAST(b AS INT) AS bin, count(confidence) AS n FROM range(20) r(b)
LEFT JOIN (SELECT confidence, least(floor((confidence - lo) / ((hi - lo) / 20)), 19) AS bin FROM a, l) x ON x.bin = b
GROUP BY 1"""))
def confidence_histogram(spark, sf_dir):
    attacks = confident(spark, sf_dir).filter(F.col("prediction") == 1)
    return profile.histogram(attacks, "confidence", bins=20).select("bin", "n")


@query("d9_invalid_counts", with_flows("""
SELECT count(*) FILTER (flow_byts_s IS NULL OR isnan(flow_byts_s)) AS n_missing,
  count(*) FILTER (isinf(flow_byts_s)) AS n_infinite, false AS is_valid FROM flows"""))
def invalid_counts(spark, sf_dir):
    return profile.invalid_counts(flows(spark, sf_dir), NUMERIC)


@query("d10_column_summary", with_flows(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value,
  round(avg({c}), 6) AS mean_value, round(stddev_samp({c}), 6) AS std_value FROM flows""" for c in SCALED)))
def column_summary(spark, sf_dir):
    out = profile.column_summary(flows(spark, sf_dir), SCALED)
    return out.select("column_name", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("d10_summary_after_scaling", with_flows(f"""
WITH t AS (SELECT * FROM flows WHERE flow_ts < TIMESTAMP '{TRAIN_END}'),
""" + ",\n".join(f"""x_{c} AS (SELECT ({c} - m) / s AS v FROM t,
  (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM t) p)""" for c in SCALED) + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(min(v), 4) + 0e0 AS min_value, round(max(v), 4) + 0e0 AS max_value,
  round(avg(v), 4) + 0e0 AS mean_value, round(stddev_samp(v), 4) AS std_value FROM x_{c}""" for c in SCALED)))
def summary_after_scaling(spark, sf_dir):
    train, _, _ = splitting.split_by_time(flows(spark, sf_dir), "flow_ts", TRAIN_END)
    out = profile.column_summary(scaling.apply_scaler(train, scaling.fit_scaler(train, SCALED)), SCALED)
    return out.select("column_name", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in out.columns[1:]])


@query("d11_value_counts", with_flows(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM flows GROUP BY 2"
    for c in ("fwd_urg_flags", "bwd_urg_flags", "dst_port"))))
def value_counts(spark, sf_dir):
    return profile.value_counts(flows(spark, sf_dir), ["fwd_urg_flags", "bwd_urg_flags", "dst_port"])


@query("d12_unparsable_report", with_flows(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS n_unparsable, count(*) AS n_distinct,
  string_agg(v, '|' ORDER BY v) FILTER (rk <= 3) AS sample_values
FROM (SELECT {c} AS v, count(*) AS n, row_number() OVER (ORDER BY {c}) AS rk FROM flows
  WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL GROUP BY {c}) t"""
    for c in ("delta_start", "label", "protocol"))))
def unparsable_report(spark, sf_dir):
    return profile.unparsable_report(flows(spark, sf_dir), ["delta_start", "label", "protocol"])


@query("d13_distinct_values", with_flows("SELECT DISTINCT protocol FROM flows"))
def distinct_values(spark, sf_dir):
    return profile.distinct_values(flows(spark, sf_dir), "protocol")


SUMMARY_SQL = """SELECT count(*) AS total_flows, count(*) FILTER (prediction = 1) AS attacks_detected,
  count(*) FILTER (prediction = 0) AS benign_flows,
  round(count(*) FILTER (prediction = 1) * 100e0 / count(*), 2) AS attack_rate_percent,
  count(*) FILTER (prediction = 1 AND p >= 0.8e0) AS high_confidence_attacks,
  round(coalesce(avg(p) FILTER (prediction = 1), 0e0), 4) AS avg_attack_probability,
  round(coalesce(max(p), 0e0), 4) AS max_attack_probability FROM scored"""


@query("d14_batch_summary", with_scored(SUMMARY_SQL))
def batch_summary(spark, sf_dir):
    return scoring.batch_summary(confident(spark, sf_dir))


@query("d15_batch_totals", with_scored("""
SELECT count(*) AS total_flows, count(*) FILTER (prediction = 1) AS attacks_detected,
  round(count(*) FILTER (prediction = 1) * 100e0 / count(*), 2) AS attack_percentage FROM scored"""))
def batch_totals(spark, sf_dir):
    return scoring.batch_response(confident(spark, sf_dir), "flow_id")[0]


@query("d15_batch_response_rows", with_scored(f"""
SELECT flow_id, prediction, CASE WHEN prediction = 1 THEN 'attack' ELSE 'benign' END AS prediction_label,
  attack_probability, confidence FROM ({CONFIDENT_SQL}) s ORDER BY flow_id LIMIT 100"""))
def batch_response_rows(spark, sf_dir):
    return scoring.batch_response(confident(spark, sf_dir), "flow_id")[1]


@query("d16_running_totals", with_scored("""
WITH t AS (SELECT flow_ts, count(*) AS n, count(*) FILTER (prediction = 1) AS a FROM scored GROUP BY 1)
SELECT flow_ts, CAST(sum(n) OVER w AS BIGINT) AS total_flows, CAST(sum(a) OVER w AS BIGINT) AS total_attacks,
  round(sum(a) OVER w * 100e0 / sum(n) OVER w, 6) AS attack_rate_pct FROM t WINDOW w AS (ORDER BY flow_ts)"""))
def running_totals(spark, sf_dir):
    return profile.running_totals(scored(spark, sf_dir), "flow_ts").withColumn(
        "attack_rate_pct", F.round("attack_rate_pct", 6))


@query("d17_interarrival_stats", with_flows("""
SELECT count(*) AS n_flows, min(flow_ts) AS first_ts, max(flow_ts) AS last_ts,
  (epoch_us(max(flow_ts)) - epoch_us(min(flow_ts))) / 1e6 AS duration_s,
  (epoch_us(max(flow_ts)) - epoch_us(min(flow_ts))) / 1e6 / (count(*) - 1) AS mean_gap_s FROM flows"""))
def interarrival(spark, sf_dir):
    return profile.interarrival_stats(flows(spark, sf_dir), "flow_ts")


@query("d17_interarrival_by_source", with_flows("""
SELECT src_id, count(*) AS n_flows, min(flow_ts) AS first_ts, max(flow_ts) AS last_ts,
  (epoch_us(max(flow_ts)) - epoch_us(min(flow_ts))) / 1e6 AS duration_s,
  CASE WHEN count(*) > 1 THEN (epoch_us(max(flow_ts)) - epoch_us(min(flow_ts))) / 1e6 / (count(*) - 1) END
    AS mean_gap_s FROM flows GROUP BY src_id"""))
def interarrival_by_source(spark, sf_dir):
    return profile.interarrival_stats(flows(spark, sf_dir), "flow_ts", "src_id")


@query("d18_recent_stats", with_scored(f"""
SELECT count(*) AS n_recent, count(*) FILTER (prediction = 1) AS n_attacks, round(avg(confidence), 6) AS avg_confidence
FROM (SELECT * FROM ({CONFIDENT_SQL}) s ORDER BY flow_ts DESC, flow_id DESC LIMIT 100) r"""))
def recent_stats(spark, sf_dir):
    return profile.recent_stats(confident(spark, sf_dir), "flow_ts", "flow_id").withColumn(
        "avg_confidence", F.round("avg_confidence", 6))


@query("s1_time_ordered_head", with_flows(
    "SELECT flow_id, flow_ts, src_id FROM flows ORDER BY flow_ts, flow_id LIMIT 500"))
def time_ordered_head(spark, sf_dir):
    return ordering.time_ordered_head(flows(spark, sf_dir).select("flow_id", "flow_ts", "src_id"),
                                      "flow_ts", "flow_id", 500)


@query("s2_top_k", with_flows(
    "SELECT flow_id, totlen_fwd_pkts FROM flows ORDER BY totlen_fwd_pkts DESC, flow_id LIMIT 20"))
def top_k(spark, sf_dir):
    return ordering.top_k(flows(spark, sf_dir).select("flow_id", "totlen_fwd_pkts"), "totlen_fwd_pkts", 20, "flow_id")


GAP_SQL = """SELECT flow_id, src_id, (epoch_us(flow_ts) - epoch_us(lag(flow_ts)
  OVER (PARTITION BY src_id ORDER BY flow_ts, flow_id))) / 1e6 AS gap_s FROM flows"""


@query("s3_with_gap", with_flows(GAP_SQL))
def with_gap(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "src_id", "flow_ts")
    return ordering.with_gap(df, "flow_ts", "src_id", "flow_id").select(
        "flow_id", "src_id", "gap_s")


@query("s3_with_gap_sliced", with_flows(GAP_SQL))
def with_gap_sliced(spark, sf_dir):
    """The same result from ordered slices of a tenth of the rows each, as large tables are run."""
    df = flows(spark, sf_dir).select("flow_id", "src_id", "flow_ts")
    out = ordering.with_gap(df, "flow_ts", "src_id", "flow_id", rows_per_slice=max(1, df.count() // 10))
    return out.select("flow_id", "src_id", "gap_s")


@query("s8_union_all", with_flows("""
SELECT protocol, count(*) AS n, count(extra) AS n_extra FROM (
  SELECT protocol, NULL AS extra FROM flows WHERE protocol = 'tcp'
  UNION ALL SELECT protocol, src_port FROM flows WHERE protocol <> 'tcp') u GROUP BY 1"""))
def union_all(spark, sf_dir):
    df = flows(spark, sf_dir)
    parts = [df.filter(F.col("protocol") == "tcp").select("protocol"),
             df.filter(F.col("protocol") != "tcp").select("protocol", F.col("src_port").alias("extra"))]
    return ordering.union_all(parts).groupBy("protocol").agg(
        F.count("*").alias("n"), F.count("extra").alias("n_extra"))
