"""Queries over the cleaning, splitting and weighting operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.operators import balance, cleaning, joins, scaling, splitting
from flowlab.operators.features import binary_target
from flowlab.plans.catalog import query
from flowlab.plans.flows import flows, table, with_flows, with_labeled
from flowlab.session import fresh_folder
from flowlab.sources import write_bucketed

TRAIN_END, VAL_END = "2024-01-19", "2024-01-25"
NUMERIC = ["flow_duration", "tot_fwd_pkts", "tot_bwd_pkts", "totlen_fwd_pkts", "totlen_bwd_pkts",
           "pkt_len_mean", "pkt_len_std", "flow_iat_mean", "flow_iat_std", "flow_byts_s"]


def labeled(spark, sf_dir):
    return (flows(spark, sf_dir).transform(cleaning.drop_unlabeled, "label")
            .transform(cleaning.normalize_labels, "label"))


def finite_case(c: str) -> str:
    return f"CASE WHEN isfinite({c}) THEN {c} END"


@query("b1_split_by_time", with_flows(f"""
SELECT flow_id, flow_ts, CASE WHEN flow_ts < TIMESTAMP '{TRAIN_END}' THEN 'train'
  WHEN flow_ts < TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split
FROM flows WHERE flow_ts IS NOT NULL"""))
def split_by_time(spark, sf_dir):
    parts = splitting.split_by_time(flows(spark, sf_dir).select("flow_id", "flow_ts"), "flow_ts",
                                    TRAIN_END, VAL_END)
    named = [p.withColumn("split", F.lit(n)) for p, n in zip(parts, ("train", "val", "test"), strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("b1_time_split_column", with_flows(f"""
SELECT CASE WHEN flow_ts < TIMESTAMP '{TRAIN_END}' THEN 'train'
  WHEN flow_ts < TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split, count(*) AS n
FROM flows GROUP BY 1"""))
def time_split_column(spark, sf_dir):
    marked = splitting.with_time_split(flows(spark, sf_dir), "flow_ts", TRAIN_END, VAL_END)
    return marked.groupBy("split").agg(F.count("*").alias("n"))


@query("b2_drop_unlabeled", with_flows("SELECT flow_id, label FROM flows WHERE label IS NOT NULL"))
def drop_unlabeled(spark, sf_dir):
    return cleaning.drop_unlabeled(flows(spark, sf_dir).select("flow_id", "label"), "label")


@query("b3_normalize_labels", with_labeled("SELECT flow_id, label, is_attack, attack_type FROM labeled"))
def normalize_labels(spark, sf_dir):
    return labeled(spark, sf_dir).select("flow_id", "label", "is_attack", "attack_type")


@query("b4_fill_missing_zero", with_flows("""
SELECT flow_id, tot_fwd_pkts, flow_duration,
       CASE WHEN isfinite(flow_byts_s) THEN flow_byts_s ELSE 0e0 END AS flow_byts_s
FROM flows WHERE label IS NOT NULL"""))
def fill_missing_zero(spark, sf_dir):
    filled = cleaning.fill_missing_zero(flows(spark, sf_dir), label="label")
    return filled.select("flow_id", "tot_fwd_pkts", "flow_duration", "flow_byts_s")


@query("b4_fill_missing_zero_keep_inf", with_flows("""
SELECT flow_id, CASE WHEN flow_byts_s IS NULL OR isnan(flow_byts_s) THEN 0e0 ELSE flow_byts_s END AS flow_byts_s
FROM flows WHERE label IS NOT NULL"""))
def fill_missing_zero_keep_inf(spark, sf_dir):
    filled = cleaning.fill_missing_zero(flows(spark, sf_dir), inf_as_null=False, label="label")
    return filled.select("flow_id", "flow_byts_s")


@query("b5_drop_sparse_columns", with_flows("SELECT flow_id, src_id, flow_byts_s FROM flows"))
def drop_sparse_columns(spark, sf_dir):
    sparse = F.when(F.col("tot_fwd_pkts") % 3 == 0, F.col("flow_duration"))
    df = flows(spark, sf_dir).select("flow_id", "src_id", "flow_byts_s", sparse.alias("rarely_set"))
    return cleaning.drop_sparse_columns(df, 0.5)


@query("b6_fit_median", with_flows(
    " UNION ALL ".join(f"""SELECT '{c}' AS column_name,
  round(quantile_cont(CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END, 0.5), 6) AS median
FROM flows""" for c in NUMERIC)))
def fit_median(spark, sf_dir):
    medians = cleaning.fit_median(flows(spark, sf_dir), NUMERIC)
    return spark.createDataFrame(list(medians.items()), "column_name string, median double").withColumn(
        "median", F.round("median", 6))


@query("b6_fill_median", with_flows("""
SELECT flow_id, round(CASE WHEN flow_byts_s IS NULL OR isnan(flow_byts_s) THEN
  (SELECT quantile_cont(CASE WHEN NOT isnan(flow_byts_s) THEN flow_byts_s END, 0.5) FROM flows)
  ELSE flow_byts_s END, 6) AS flow_byts_s FROM flows"""))
def fill_median(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "flow_byts_s")
    filled = cleaning.apply_fill(df, cleaning.fit_median(df, ["flow_byts_s"]))
    return filled.withColumn("flow_byts_s", F.round("flow_byts_s", 6))


@query("b7_coerce_numeric", with_flows("""
SELECT flow_id, coalesce(TRY_CAST(delta_start AS DOUBLE),
  (SELECT quantile_cont(TRY_CAST(delta_start AS DOUBLE), 0.5) FROM flows), 0e0) AS delta_start,
  0e0 AS never_number FROM flows"""))
def coerce_numeric(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "delta_start", F.lit("n/a").alias("never_number"))
    return cleaning.coerce_numeric(df, ["delta_start", "never_number"])


@query("b8_inf_to_median", with_flows(f"""
SELECT flow_id, round(coalesce({finite_case('flow_byts_s')},
  (SELECT quantile_cont({finite_case('flow_byts_s')}, 0.5) FROM flows)), 6) AS flow_byts_s FROM flows"""))
def inf_to_median(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "flow_byts_s")
    return cleaning.inf_to_median(df, ["flow_byts_s"]).withColumn("flow_byts_s", F.round("flow_byts_s", 6))


@query("b9_drop_duplicates", "SELECT DISTINCT * REPLACE (l_discount + 0e0 AS l_discount) FROM lineitem")
def drop_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return cleaning.drop_duplicates(lines.withColumn("l_discount", F.col("l_discount") + F.lit(0.0)))


@query("b9_duplicate_report", """
WITH d AS (SELECT DISTINCT * FROM lineitem),
     q AS (SELECT count(*) AS n FROM lineitem GROUP BY l_quantity, l_returnflag)
SELECT 'line' AS subset, (SELECT count(*) FROM lineitem) AS n_rows, count(*) AS n_distinct,
       (SELECT count(*) FROM lineitem) - count(*) AS n_removed FROM d
UNION ALL SELECT 'quantity', CAST(sum(n) AS BIGINT), count(*), CAST(sum(n) - count(*) AS BIGINT) FROM q""")
def duplicate_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    whole = cleaning.duplicate_report(lines, lines.columns).withColumn("subset", F.lit("line"))
    part = cleaning.duplicate_report(lines, ["l_quantity", "l_returnflag"]).withColumn("subset", F.lit("quantity"))
    return whole.unionByName(part)


def _outlier_steps(cols: list[str]) -> str:
    steps, src = [], "flows"
    for i, c in enumerate(cols):
        steps.append(f"""q{i} AS (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {src}),
s{i} AS (SELECT {src}.* FROM {src}, q{i} WHERE {c} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1))""")
        src = f"s{i}"
    return "WITH " + ", ".join(steps) + f" SELECT flow_id, {', '.join(cols)} FROM {src}"


OUTLIER_COLS = ["flow_duration", "totlen_fwd_pkts", "totlen_bwd_pkts"]


@query("b10_remove_outliers_iqr", with_flows(_outlier_steps(OUTLIER_COLS)))
def remove_outliers_iqr(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", *OUTLIER_COLS)
    return cleaning.remove_outliers_iqr(df, OUTLIER_COLS)


@query("b10_remove_outliers_one_pass", with_flows("""
WITH q AS (SELECT quantile_cont(flow_duration, 0.25) AS a1, quantile_cont(flow_duration, 0.75) AS a3,
  quantile_cont(totlen_fwd_pkts, 0.25) AS b1, quantile_cont(totlen_fwd_pkts, 0.75) AS b3 FROM flows)
SELECT flow_id FROM flows, q WHERE flow_duration BETWEEN a1 - 1.5e0 * (a3 - a1) AND a3 + 1.5e0 * (a3 - a1)
  AND totlen_fwd_pkts BETWEEN b1 - 1.5e0 * (b3 - b1) AND b3 + 1.5e0 * (b3 - b1)"""))
def remove_outliers_one_pass(spark, sf_dir):
    df = flows(spark, sf_dir).select("flow_id", "flow_duration", "totlen_fwd_pkts")
    return cleaning.remove_outliers_iqr(df, ["flow_duration", "totlen_fwd_pkts"], sequential=False).select("flow_id")


@query("b11_align_features", with_flows(
    "SELECT flow_id, tot_bwd_pkts, 0 AS not_there, tot_fwd_pkts, flow_duration FROM flows"))
def align_features(spark, sf_dir):
    return cleaning.align_features(
        flows(spark, sf_dir), ["tot_bwd_pkts", "not_there", "tot_fwd_pkts", "flow_duration"], keep=["flow_id"])


@query("b12_drop_identifiers", with_flows("""
SELECT count(*) AS n, count(DISTINCT protocol) AS n_protocols, 19 AS n_columns FROM flows"""))
def drop_identifiers(spark, sf_dir):
    left = cleaning.drop_identifiers(flows(spark, sf_dir), ("flow_id", "src_id", "flow_ts", "dst_ip"))
    return left.agg(F.count("*").alias("n"), F.countDistinct("protocol").alias("n_protocols"),
                    F.lit(len(left.columns)).alias("n_columns"))


@query("b14_columns_by_type", with_flows("""
SELECT 'numeric' AS kind, 18 AS n_columns, max(tot_fwd_pkts) AS max_fwd FROM flows
UNION ALL SELECT 'other', 4, max(tot_fwd_pkts) FROM flows
UNION ALL SELECT 'numeric pkt', 6, max(tot_fwd_pkts) FROM flows"""))
def columns_by_type(spark, sf_dir):
    df = flows(spark, sf_dir)
    picks = {"numeric": cleaning.columns_by_type(df), "other": cleaning.columns_by_type(df, "other"),
             "numeric pkt": cleaning.columns_by_type(df, "numeric", "pkt")}
    cells = [F.struct(F.lit(k).alias("kind"), F.lit(len(v)).alias("n_columns"),
                      F.max("tot_fwd_pkts").alias("max_fwd")) for k, v in picks.items()]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


PREPROCESSED_SQL = """SELECT DISTINCT * REPLACE (
    CASE WHEN isfinite(flow_byts_s) THEN flow_byts_s ELSE 0e0 END AS flow_byts_s, trim(label) AS label),
  CASE WHEN lower(trim(label)) = 'benign' THEN 0 ELSE 1 END AS is_attack, trim(label) AS attack_type
FROM flows WHERE label IS NOT NULL"""


@query("b16_preprocess", with_flows(PREPROCESSED_SQL))
def preprocess(spark, sf_dir):
    return cleaning.preprocess(flows(spark, sf_dir), label="label")


@query("b16_preprocess_no_outliers", with_flows(f"""
WITH base AS ({PREPROCESSED_SQL}),
q AS (SELECT quantile_cont(flow_duration, 0.25) AS q1, quantile_cont(flow_duration, 0.75) AS q3 FROM base)
SELECT base.* FROM base, q WHERE flow_duration BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)"""))
def preprocess_no_outliers(spark, sf_dir):
    """Rows whose duration lies within the quartile fences."""
    return cleaning.preprocess(flows(spark, sf_dir), True, "label", ["flow_duration"])


@query("a6_hash_sample", with_flows(
    "SELECT flow_id FROM flows WHERE substr(md5(concat_ws(':', CAST(flow_id AS VARCHAR), '42')), 1, 8) < '19999999'"))
def hash_sample(spark, sf_dir):
    return splitting.hash_sample(flows(spark, sf_dir).select("flow_id"), "flow_id", 0.1)


@query("a6_sample")
def sample(spark, sf_dir):
    taken = splitting.sample(flows(spark, sf_dir), 0.1)
    return taken.agg(F.count("*").alias("n_sampled"), F.count_distinct("flow_id").alias("n_distinct"))


@query("a10_time_slice", with_flows("""
SELECT flow_id, flow_ts FROM flows
WHERE flow_ts >= TIMESTAMP '2024-01-05 09:15:00' AND flow_ts < TIMESTAMP '2024-01-05 21:46:00'"""))
def time_slice(spark, sf_dir):
    return splitting.time_slice(flows(spark, sf_dir), "flow_ts", "2024-01-05 09:15:00",
                                "2024-01-05 21:46:00").select("flow_id", "flow_ts")


@query("c17_binary_columns", with_flows(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, coalesce(bool_and({c} IN (0, 1)), true) AS is_binary FROM flows WHERE {c} IS NOT NULL"
    for c in ("fwd_urg_flags", "bwd_urg_flags", "fin_flag_cnt", "tot_fwd_pkts", "flow_duration"))))
def binary_columns(spark, sf_dir):
    cols = ["fwd_urg_flags", "bwd_urg_flags", "fin_flag_cnt", "tot_fwd_pkts", "flow_duration"]
    flags = scaling.binary_flags(flows(spark, sf_dir), cols)
    return spark.createDataFrame(list(flags.items()), "column_name string, is_binary boolean")


SCALED = ["flow_duration", "tot_fwd_pkts", "pkt_len_std", "flow_iat_std"]


@query("c18_scale_continuous", with_flows(f"""
WITH t AS (SELECT * FROM flows WHERE flow_ts < TIMESTAMP '{TRAIN_END}'),
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in SCALED)} FROM t)
SELECT flow_id, fwd_urg_flags, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) + 0e0 AS {c}' for c in SCALED)}
FROM flows, s WHERE flow_ts >= TIMESTAMP '{TRAIN_END}'"""))
def scale_continuous(spark, sf_dir):
    train, val, test = splitting.split_by_time(flows(spark, sf_dir), "flow_ts", TRAIN_END, VAL_END)
    model = scaling.fit_continuous_scaler(train, [*SCALED, "fwd_urg_flags"])
    scaled = scaling.apply_scaler(val.unionByName(test), model)
    return scaled.select("flow_id", "fwd_urg_flags",
                         *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in SCALED])


@query("c19_stratified_split", with_labeled("""
WITH c AS (SELECT is_attack AS y, count(*) AS n FROM labeled GROUP BY 1),
q AS (SELECT y, n, n // 5 AS base, (n % 5) AS rest,
        (CAST(sum(n) OVER () AS BIGINT) + 4) // 5 - CAST(sum(n // 5) OVER () AS BIGINT) AS left_over,
        row_number() OVER (ORDER BY n % 5 DESC, y) AS ord FROM c),
quota AS (SELECT y, base + CASE WHEN ord <= left_over THEN 1 ELSE 0 END AS quota FROM q),
r AS (SELECT flow_id, is_attack, row_number() OVER (PARTITION BY is_attack
        ORDER BY md5(concat_ws(':', CAST(flow_id AS VARCHAR), '42')), flow_id) AS rk FROM labeled)
SELECT flow_id, is_attack, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN quota ON r.is_attack = quota.y"""))
def stratified_split(spark, sf_dir):
    df = labeled(spark, sf_dir).select("flow_id", "is_attack")
    return splitting.fit_stratified_split(df, "flow_id", "is_attack").mark(df)


@query("c21_class_weights", with_labeled("""
SELECT label, count(*) AS n, round((SELECT count(*) FROM labeled) * 1e0 /
  ((SELECT count(DISTINCT label) FROM labeled) * count(*)), 9) AS weight FROM labeled GROUP BY label"""))
def class_weights(spark, sf_dir):
    return balance.class_weights(labeled(spark, sf_dir), "label").withColumn("weight", F.round("weight", 9))


@query("c22_pos_weight", with_labeled("""
SELECT count(*) FILTER (is_attack = 0) AS n_negative, count(*) FILTER (is_attack = 1) AS n_positive,
  round(count(*) FILTER (is_attack = 0) * 1e0 / count(*) FILTER (is_attack = 1), 9) AS pos_weight FROM labeled"""))
def pos_weight(spark, sf_dir):
    return balance.pos_weight(labeled(spark, sf_dir)).withColumn("pos_weight", F.round("pos_weight", 9))


@query("c23_sample_weight", with_labeled("""
WITH w AS (SELECT is_attack AS y, (SELECT count(*) FROM labeled) * 1e0 / (2 * count(*)) AS weight
  FROM labeled GROUP BY 1)
SELECT flow_id, is_attack, round(weight, 9) AS weight FROM labeled JOIN w ON is_attack = y"""))
def sample_weight(spark, sf_dir):
    df = labeled(spark, sf_dir).select("flow_id", "is_attack")
    return balance.with_sample_weight(df).withColumn("weight", F.round("weight", 9))


BUCKETS = 16


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    path = fresh_folder(df.sparkSession, name)
    return write_bucketed(df, path, path.rsplit("/", 1)[-1].replace("-", "_"), key, BUCKETS)


@query("j1_join_labels", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def join_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return joins.join_labels(docs, table(spark, sf_dir, "labels"), "doc_id")


@query("j1_join_labels_bucketed", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def join_labels_bucketed(spark, sf_dir):
    """Both tables written in buckets of the key first; the join itself shuffles nothing."""
    docs = bucketed(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "docs", "doc_id")
    return joins.join_labels(docs, bucketed(table(spark, sf_dir, "labels"), "labels", "doc_id"), "doc_id")


@query("j2_attach_class_value", """
WITH w AS (SELECT toxic AS t, (SELECT count(*) FROM labels) * 1e0 / (2 * count(*)) AS weight FROM labels GROUP BY 1)
SELECT doc_id, toxic, round(weight, 9) AS weight FROM labels JOIN w ON toxic = t""")
def attach_class_value(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    weights = balance.class_weights(labels, "toxic").select("toxic", "weight")
    return joins.attach_class_value(labels, weights, "toxic").withColumn("weight", F.round("weight", 9))


@query("j3_join_truth", with_flows("""
SELECT p.flow_id, CASE WHEN p.tot_fwd_pkts >= 50 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN lower(trim(t.label)) = 'benign' THEN 0 ELSE 1 END AS is_attack
FROM flows p JOIN flows t ON p.flow_id = t.flow_id"""))
def join_truth(spark, sf_dir):
    df = flows(spark, sf_dir)
    pred = df.select("flow_id", F.when(F.col("tot_fwd_pkts") >= 50, 1).otherwise(0).alias("prediction"))
    truth = binary_target(df, "label").select("flow_id", "is_attack")
    return joins.join_truth(pred, truth, "flow_id")


@query("j3_join_truth_bucketed", with_flows("""
SELECT p.flow_id, CASE WHEN p.tot_fwd_pkts >= 50 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN lower(trim(t.label)) = 'benign' THEN 0 ELSE 1 END AS is_attack
FROM flows p JOIN flows t ON p.flow_id = t.flow_id"""))
def join_truth_bucketed(spark, sf_dir):
    df = flows(spark, sf_dir)
    pred = df.select("flow_id", F.when(F.col("tot_fwd_pkts") >= 50, 1).otherwise(0).alias("prediction"))
    truth = binary_target(df, "label").select("flow_id", "is_attack")
    return joins.join_truth(bucketed(pred, "pred", "flow_id"), bucketed(truth, "truth", "flow_id"), "flow_id")
