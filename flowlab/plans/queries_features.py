"""Queries over the feature operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.functions import bytes_per_packet, coef_variation, packet_rate, safe_ratio
from flowlab.operators import cleaning, features
from flowlab.operators.profile import long_aggregate
from flowlab.plans.catalog import query
from flowlab.plans.flows import flows, with_flows
from flowlab.schema import SNAKE_NAMES

TEMPORAL_SQL = """hour(flow_ts) AS hour_of_day, dayofweek(flow_ts) + 1 AS day_of_week,
  minute(flow_ts) AS minute_of_hour, CASE WHEN hour(flow_ts) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours"""
TEMPORAL_SQL = TEMPORAL_SQL.replace("hour(flow_ts) AS", "CAST(hour(flow_ts) AS INT) AS", 1).replace(
    "dayofweek(flow_ts) + 1 AS", "CAST(dayofweek(flow_ts) + 1 AS INT) AS").replace(
    "minute(flow_ts) AS", "CAST(minute(flow_ts) AS INT) AS")


def ratio_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN ({num}) / CAST(({den}) AS DOUBLE) ELSE 0e0 END"


FWD_BWD = ratio_sql("tot_fwd_pkts", "tot_bwd_pkts")
BYTES = ratio_sql("totlen_fwd_pkts + totlen_bwd_pkts", "tot_fwd_pkts + tot_bwd_pkts")
RATE = ratio_sql("tot_fwd_pkts + tot_bwd_pkts", "flow_duration") + " * 1e6"
LEN_CV = ratio_sql("pkt_len_std", "pkt_len_mean")
IAT_CV = ratio_sql("flow_iat_std", "flow_iat_mean")
SYN_FIN = ratio_sql("syn_flag_cnt", "fin_flag_cnt")
URGENT = "CASE WHEN fwd_urg_flags > 0 OR bwd_urg_flags > 0 THEN 1 ELSE 0 END"


def log_sql(c: str) -> str:
    return f"round(CASE WHEN {c} > -1 THEN ln(1 + {c}) END, 9) AS {c}_log"


@query("c1_temporal_features", with_flows(f"SELECT flow_id, {TEMPORAL_SQL} FROM flows"))
def temporal(spark, sf_dir):
    return features.temporal_features(flows(spark, sf_dir), "flow_ts").select(
        "flow_id", "hour_of_day", "day_of_week", "minute_of_hour", "is_business_hours")


@query("c1_temporal_from_text", with_flows(f"SELECT flow_id, {TEMPORAL_SQL} FROM flows"))
def temporal_from_text(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", F.date_format("flow_ts", "dd/MM/yyyy HH:mm:ss").alias("Timestamp"))
    return features.temporal_features(df, formats=["dd/MM/yyyy HH:mm:ss"]).select(
        "flow_id", "hour_of_day", "day_of_week", "minute_of_hour", "is_business_hours")


@query("c2_fwd_bwd_pkt_ratio", with_flows(f"SELECT flow_id, {FWD_BWD} AS fwd_bwd_pkt_ratio FROM flows"))
def fwd_bwd(spark, sf_dir):
    return flows(spark, sf_dir).select(
        "flow_id", safe_ratio("tot_fwd_pkts", "tot_bwd_pkts").alias("fwd_bwd_pkt_ratio"))


@query("c3_bytes_per_pkt", with_flows(f"SELECT flow_id, {BYTES} AS bytes_per_pkt FROM flows"))
def bytes_per_pkt(spark, sf_dir):
    return flows(spark, sf_dir).select("flow_id", bytes_per_packet(
        "totlen_fwd_pkts", "totlen_bwd_pkts", "tot_fwd_pkts", "tot_bwd_pkts").alias("bytes_per_pkt"))


@query("c4_pkt_rate", with_flows(f"SELECT flow_id, {RATE} AS pkt_rate FROM flows"))
def pkt_rate(spark, sf_dir):
    return flows(spark, sf_dir).select(
        "flow_id", packet_rate("tot_fwd_pkts", "tot_bwd_pkts", "flow_duration").alias("pkt_rate"))


@query("c5_pkt_len_cv", with_flows(f"SELECT flow_id, {LEN_CV} AS pkt_len_cv FROM flows"))
def pkt_len_cv(spark, sf_dir):
    return flows(spark, sf_dir).select("flow_id", coef_variation("pkt_len_std", "pkt_len_mean").alias("pkt_len_cv"))


@query("c6_iat_cv", with_flows(f"SELECT flow_id, {IAT_CV} AS iat_cv FROM flows"))
def iat_cv(spark, sf_dir):
    return flows(spark, sf_dir).select("flow_id", coef_variation("flow_iat_std", "flow_iat_mean").alias("iat_cv"))


@query("c7_syn_fin_ratio", with_flows(f"SELECT flow_id, {SYN_FIN} AS syn_fin_ratio FROM flows"))
def syn_fin(spark, sf_dir):
    return features.flag_features(flows(spark, sf_dir), SNAKE_NAMES).select("flow_id", "syn_fin_ratio")


@query("c8_has_urgent_pkts", with_flows(f"SELECT flow_id, {URGENT} AS has_urgent_pkts FROM flows"))
def urgent(spark, sf_dir):
    return features.flag_features(flows(spark, sf_dir), SNAKE_NAMES).select("flow_id", "has_urgent_pkts")


@query("c9_log1p_features", with_flows(f"""
SELECT flow_id, {log_sql('flow_duration')}, {log_sql('tot_fwd_pkts')}, {log_sql('below')}
FROM (SELECT *, pkt_len_std - 20 AS below FROM flows) f"""))
def log1p(spark, sf_dir):
    df = flows(spark, sf_dir).withColumn("below", F.col("pkt_len_std") - 20)
    out = features.log1p_features(df, ["flow_duration", "tot_fwd_pkts", "below", "absent"])
    return out.select("flow_id", *[F.round(c, 9).alias(c) for c in
                                   ("flow_duration_log", "tot_fwd_pkts_log", "below_log")])


@query("c10_engineer_features", with_flows(f"""
SELECT flow_id, {TEMPORAL_SQL}, {FWD_BWD} AS fwd_bwd_pkt_ratio, {BYTES} AS bytes_per_pkt, {RATE} AS pkt_rate,
  {LEN_CV} AS pkt_len_cv, {IAT_CV} AS iat_cv, {SYN_FIN} AS syn_fin_ratio, {URGENT} AS has_urgent_pkts,
  {', '.join(log_sql(c) for c in SNAKE_NAMES.skewed[:5])} FROM flows"""))
def engineer(spark, sf_dir):
    df = features.engineer_features(flows(spark, sf_dir), SNAKE_NAMES)
    logs = [f"{c}_log" for c in SNAKE_NAMES.skewed[:5]]
    return df.select("flow_id", "hour_of_day", "day_of_week", "minute_of_hour", "is_business_hours",
                     "fwd_bwd_pkt_ratio", "bytes_per_pkt", "pkt_rate", "pkt_len_cv", "iat_cv",
                     "syn_fin_ratio", "has_urgent_pkts", *[F.round(c, 9).alias(c) for c in logs])


SERVICE_SQL = ", ".join(f"CASE WHEN dst_port IN ({', '.join(map(str, p))}) THEN 1 ELSE 0 END AS dst_port_{s}"
                        for s, p in features.SERVICES.items())
RANGE_SQL = """CASE WHEN dst_port < 1024 THEN 1 ELSE 0 END AS dst_port_cat_well_known,
  CASE WHEN dst_port >= 1024 AND dst_port < 49152 THEN 1 ELSE 0 END AS dst_port_cat_registered,
  CASE WHEN dst_port >= 49152 THEN 1 ELSE 0 END AS dst_port_cat_ephemeral"""
SRC_SQL = """CASE WHEN src_port < 1024 THEN 1 ELSE 0 END AS src_port_is_privileged,
  CASE WHEN src_port >= 49152 THEN 1 ELSE 0 END AS src_port_is_ephemeral"""
PROTOCOL_SQL = ", ".join(f"CASE WHEN upper(protocol) = '{p.upper()}' THEN 1 ELSE 0 END AS protocol_{p}"
                         for p in features.PROTOCOLS)


@query("c11_service_flags", with_flows(f"SELECT flow_id, {SERVICE_SQL} FROM flows"))
def services(spark, sf_dir):
    return features.service_flags(flows(spark, sf_dir)).select(
        "flow_id", *[f"dst_port_{s}" for s in features.SERVICES])


@query("c12_port_range_onehot", with_flows(f"SELECT flow_id, {RANGE_SQL} FROM flows"))
def port_range(spark, sf_dir):
    return features.port_range_onehot(flows(spark, sf_dir)).select(
        "flow_id", "dst_port_cat_well_known", "dst_port_cat_registered", "dst_port_cat_ephemeral")


@query("c13_src_port_flags", with_flows(f"SELECT flow_id, {SRC_SQL} FROM flows"))
def src_port(spark, sf_dir):
    return features.src_port_flags(flows(spark, sf_dir)).select(
        "flow_id", "src_port_is_privileged", "src_port_is_ephemeral")


@query("c14_protocol_onehot", with_flows(f"SELECT flow_id, {PROTOCOL_SQL} FROM flows"))
def protocol(spark, sf_dir):
    return features.protocol_onehot(flows(spark, sf_dir)).select(
        "flow_id", "protocol_tcp", "protocol_udp", "protocol_icmp")


@query("c14_connection_features", with_flows(
    f"SELECT flow_id, {SERVICE_SQL}, {RANGE_SQL}, {SRC_SQL}, {PROTOCOL_SQL} FROM flows"))
def connection(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "dst_port", "src_port", "protocol")
    return features.connection_features(df)


@query("c15_label_codes", with_flows("""
WITH c AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INT) AS label_code
  FROM (SELECT DISTINCT label FROM flows WHERE label IS NOT NULL) d)
SELECT flow_id, flows.label, label_code FROM flows LEFT JOIN c ON flows.label = c.label"""))
def label_codes(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "label")
    return features.apply_label_codes(df, features.fit_label_codes(df, "label"), "label")


@query("c16_binary_target", with_flows("""
SELECT flow_id, CASE WHEN label = 'Benign' THEN 0 ELSE 1 END AS exact_target,
  CASE WHEN lower(trim(label)) = 'benign' THEN 0 ELSE 1 END AS loose_target FROM flows"""))
def target(spark, sf_dir):
    df = features.binary_target(flows(spark, sf_dir), "label", case_sensitive=True, out="exact_target")
    return features.binary_target(df, "label", out="loose_target").select(
        "flow_id", "exact_target", "loose_target")


@query("b13_schema_diff", with_flows("""
SELECT v.column_name, 'added' AS change, 4 AS net_change, (SELECT count(flow_ts) FROM flows) AS n_present
FROM (VALUES ('hour_of_day'), ('day_of_week'), ('minute_of_hour'), ('is_business_hours'), ('ts')) v(column_name)
UNION ALL SELECT 'flow_ts', 'removed', 4, count(flow_ts) FROM flows"""))
def schema_diff(spark, sf_dir):
    """The column changes, each with the number of values the column holds."""
    before = flows(spark, sf_dir)
    after = cleaning.drop_identifiers(features.temporal_features(before, "flow_ts"), ("flow_ts",))
    diff = cleaning.schema_diff(spark, before, after)
    gone = [c for c in before.columns if c not in after.columns]
    new = [c for c in after.columns if c not in before.columns]
    held = long_aggregate(before, gone, {"n_present": F.count}).unionByName(
        long_aggregate(after, new, {"n_present": F.count}))
    return diff.join(held, "column_name")
