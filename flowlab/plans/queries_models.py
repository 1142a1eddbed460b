"""Queries that fit models on the tables.

All models are fitted, and the searches run, at the operators' default sizes.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab import models
from flowlab.models.base import FlowModel, predict
from flowlab.models.search import materialize, score_run
from flowlab.operators import balance, scaling, scoring, splitting
from flowlab.operators.smote import smote
from flowlab.plans import jobs
from flowlab.plans.catalog import query
from flowlab.plans.flows import table, with_labeled
from flowlab.plans.queries_clean import TRAIN_END, VAL_END, labeled
from flowlab.session import fresh_folder
from flowlab.sources.writers import write_csv

FEATURES = ["dst_port", "src_port", "flow_duration", "tot_fwd_pkts", "tot_bwd_pkts", "totlen_fwd_pkts",
            "pkt_len_std", "flow_byts_s", "syn_flag_cnt", "fwd_urg_flags"]


def learn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled flows in which two of three attacks carry more backward packets."""
    shift = F.when((F.col("is_attack") == 1) & (F.col("flow_id") % 3 > 0), 6).otherwise(0)
    return labeled(spark, sf_dir).withColumn("tot_bwd_pkts", F.col("tot_bwd_pkts") + shift)


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return splitting.split_by_time(learn_rows(spark, sf_dir), "flow_ts", TRAIN_END, VAL_END)


def fitted_scores(spark: SparkSession, sf_dir: str, fit, at_once: int = 2, **options) -> DataFrame:
    """Scores of a plain and a class-weighted fit, made ``at_once``, on the rows after the training period."""
    train, val, test = parts(spark, sf_dir)
    rows, held = materialize(balance.with_sample_weight(train), "train"), val.unionByName(test)
    scaler = scaling.fit_continuous_scaler(rows, FEATURES)

    def run(weight: str | None) -> tuple[str, dict]:
        model = fit(rows, FEATURES, weight=weight, scaler=scaler, **options)
        return model.meta["model_type"], score_run(model, held, "is_attack")

    with ThreadPool(at_once) as pool:
        done = pool.map(inheritable_thread_target(spark)(run), [None, "weight"])
    out = [(kind, strategy, *[float(v) for v in values.values()])
           for strategy, (kind, values) in zip(("plain", "weighted"), done, strict=True)]
    cols = "model_type string, strategy string, " + ", ".join(f"{m} double" for m in done[0][1])
    return spark.createDataFrame(out, cols)


@query("e1_fit_logistic")
def fit_logistic(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.fit_logistic)


@query("e2_fit_random_forest")
def fit_random_forest(spark, sf_dir):
    """A forest fills the cores and holds its table with 100 draws a row, so the two come one after the other."""
    return fitted_scores(spark, sf_dir, models.fit_random_forest, at_once=1)


@query("e3_fit_gbt")
def fit_gbt(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.fit_gbt)


@query("e3_fit_gbt_validated")
def fit_gbt_validated(spark, sf_dir):
    """Boosting watches the validation period; scored on the test period."""
    train, val, test = parts(spark, sf_dir)
    rows = balance.with_pos_weight(train)
    model = models.fit_gbt(rows, FEATURES, weight="weight", val=val)
    values = score_run(model, test, "is_attack")
    return spark.createDataFrame([tuple(float(v) for v in values.values())],
                                 ", ".join(f"{m} double" for m in values))


@query("e4_fit_gbt_deep")
def fit_gbt_deep(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.fit_leafwise_gbt)


@query("e5_fit_calibrated_svm")
def fit_calibrated_svm(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.fit_calibrated_svm)


@query("e6_fit_mlp")
def fit_mlp(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.fit_mlp)


@query("e7_fit_gaussian_nb")
def fit_gaussian_nb(spark, sf_dir):
    return fitted_scores(spark, sf_dir, models.fit_gaussian_nb)


NB_COLS = ["flow_duration", "tot_fwd_pkts", "pkt_len_std"]


@query("e7_gaussian_nb_parameters", with_labeled("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT is_attack, '{c}' AS feature, round(count(*) * 1e0 / (SELECT count(*) FROM labeled), 6) AS prior,
  round(avg({c}), 4) AS mean, round(var_pop({c} * 1e-2), 4) AS variance FROM labeled GROUP BY is_attack"""
    for c in NB_COLS) + ") p"))
def nb_parameters(spark, sf_dir):
    out = models.gaussian_nb_parameters(labeled(spark, sf_dir), NB_COLS)
    return out.select("is_attack", "feature", F.round("prior", 6).alias("prior"), F.round("mean", 4).alias("mean"),
                      F.round(F.col("variance") * 1e-4, 4).alias("variance"))


@query("e7_gaussian_nb_weighted", with_labeled("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT is_attack, '{c}' AS feature, 0.5e0 AS prior, round(avg({c}), 4) AS mean FROM labeled GROUP BY is_attack"""
    for c in NB_COLS) + ") p"))
def nb_weighted(spark, sf_dir):
    rows = balance.with_sample_weight(labeled(spark, sf_dir))
    out = models.gaussian_nb_parameters(rows, NB_COLS, weight="weight")
    return out.select("is_attack", "feature", F.round("prior", 6).alias("prior"), F.round("mean", 4).alias("mean"))


def _vector_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    df = table(spark, sf_dir, "embeddings")
    cols = [f"x{i}" for i in range(df.agg(F.max(F.size("embedding"))).first()[0])]
    return df.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)]), cols


@query("e8_isolation_forest")
def isolation_forest(spark, sf_dir):
    """Share of flows called anomalous, and how far they lie from the rest."""
    rows = labeled(spark, sf_dir)
    forest = models.fit_isolation_forest(rows, "flow_id", FEATURES)
    scored = models.score_isolation_forest(rows, forest)
    return scored.groupBy("prediction").agg(
        F.count("*").alias("n"), F.round(F.avg("anomaly_score"), 6).alias("avg_score"),
        F.round(F.avg("flow_duration"), 2).alias("avg_duration"))


@query("e8_isolation_forest_vectors")
def isolation_forest_vectors(spark, sf_dir):
    rows, cols = _vector_rows(spark, sf_dir)
    forest = models.fit_isolation_forest(rows, "vec_id", cols, contamination=0.05)
    return models.score_isolation_forest(rows, forest).select(
        "vec_id", F.round("anomaly_score", 6).alias("anomaly_score"), "prediction")


@query("e8_isolation_forest_share", """
SELECT count(*) AS n, count(*) - 1 - CAST(floor(0.95e0 * (count(*) - 1)) AS BIGINT) AS n_attacks FROM embeddings""")
def isolation_forest_share(spark, sf_dir):
    """The contamination sets how many rows are called anomalous."""
    rows, cols = _vector_rows(spark, sf_dir)
    forest = models.fit_isolation_forest(rows, "vec_id", cols, contamination=0.05)
    return models.score_isolation_forest(rows, forest).agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == 1).alias("n_attacks"))


@query("e9_tune")
def tune(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    trials, _ = models.tune(train, val, FEATURES)
    return trials.select("trial", F.round("pr_auc", 6).alias("pr_auc"),
                         F.map_values("params").alias("params"))


@query("e9_tune_by_halving")
def tune_by_halving(spark, sf_dir):
    """The same points by successive halving: a trial's score is that of its last rung."""
    train, val, _ = parts(spark, sf_dir)
    trials, _ = models.tune_by_halving(train, val, FEATURES)
    return trials.select("trial", "rounds", F.round("pr_auc", 6).alias("pr_auc"),
                         F.map_values("params").alias("params"))


def grid(spark, sf_dir, **more):
    train, val, test = parts(spark, sf_dir)
    out = fresh_folder(spark, "models")
    board, model = jobs.train_best(train, val.unionByName(test), out, FEATURES, "flow_id", **more)
    return board, model, out


@query("e10_train_grid")
def train_grid(spark, sf_dir):
    """Six runs of three families and both strategies, best first."""
    board, _, _ = grid(spark, sf_dir)
    return board.drop("train_time")


@query("e12_save_model", with_labeled("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM labeled"))
def save_and_load(spark, sf_dir):
    """Rows on which a reloaded model scores otherwise than the saved one: none."""
    _, model, out = grid(spark, sf_dir, families=("LR",), strategies=("Weighted",))
    rows = learn_rows(spark, sf_dir)
    again = models.load_model(spark, f"{out}/best_model")
    here = predict(rows, model).select("flow_id", F.col("attack_probability").alias("a"))
    there = predict(rows, again).select("flow_id", F.col("attack_probability").alias("b"))
    return here.join(there, "flow_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("n_different"))


@query("e13_log_run", with_labeled("""
SELECT 'share' AS run_name, count(*) * 1e0 AS n_flows, round(avg(is_attack), 9) AS attack_share FROM labeled"""))
def log_run(spark, sf_dir):
    row = labeled(spark, sf_dir).agg(F.count("*").alias("n"), F.avg("is_attack").alias("s")).first()
    root = fresh_folder(spark, "runs")
    models.log_run(spark, root, "share", {"table": "flows"}, {"n_flows": row["n"], "attack_share": row["s"]},
                   {"kind": "profile"})
    return models.read_runs(spark, root).select("run_name", "n_flows", F.round("attack_share", 9).alias("attack_share"))


@query("f10_feature_importance")
def feature_importance(spark, sf_dir):
    train, _, _ = parts(spark, sf_dir)
    model = models.fit_random_forest(train, FEATURES)
    return models.feature_importance(model, spark, 10)


# The posterior of a Gaussian naive Bayes over NB_COLS, written out.
POSTERIOR_SQL = f"""
WITH st AS (SELECT is_attack AS y, count(*) * 1e0 / (SELECT count(*) FROM labeled) AS prior,
  {', '.join(f'avg({c}) AS m_{c}, var_pop({c}) AS v_{c}' for c in NB_COLS)} FROM labeled GROUP BY 1),
sm AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in NB_COLS)}) AS eps FROM labeled),
ll AS (SELECT flow_id, y, ln(prior) {' '.join(
    f"- ln(2 * pi() * (v_{c} + eps)) / 2 - ({c} - m_{c}) * ({c} - m_{c}) / (2 * (v_{c} + eps))" for c in NB_COLS)} AS l
  FROM labeled, st, sm),
post AS (SELECT flow_id, 1 / (1 + exp(max(l) FILTER (y = 0) - max(l) FILTER (y = 1))) AS p FROM ll GROUP BY flow_id)"""


def bayes_model(spark, sf_dir) -> tuple[FlowModel, DataFrame]:
    rows = labeled(spark, sf_dir)
    return models.fit_gaussian_nb(rows, NB_COLS), rows


@query("g1_predict", with_labeled(f"""{POSTERIOR_SQL}
SELECT flow_id, round(p, 6) AS attack_probability, CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN p >= 0.5e0 THEN 'attack' ELSE 'benign' END AS prediction_label,
  round(greatest(p, 1 - p), 6) AS confidence, p >= 0.8e0 AS high_confidence_attack FROM post"""))
def predict_flows(spark, sf_dir):
    model, rows = bayes_model(spark, sf_dir)
    return predict(rows, model, only_features=True, keep=["flow_id"]).select(
        "flow_id", F.round("attack_probability", 6).alias("attack_probability"), "prediction",
        "prediction_label", F.round("confidence", 6).alias("confidence"), "high_confidence_attack")


@query("g3_run_batch", with_labeled(f"""{POSTERIOR_SQL}
SELECT 'NB_plain' AS model_name, 'GaussianNaiveBayes' AS model_type, count(*) AS total_flows,
  count(*) FILTER (p >= 0.5e0) AS attacks_detected, count(*) FILTER (p < 0.5e0) AS benign_flows,
  round(count(*) FILTER (p >= 0.5e0) * 100e0 / count(*), 2) AS attack_rate_percent,
  count(*) FILTER (p >= 0.8e0) AS high_confidence_attacks,
  round(coalesce(avg(p) FILTER (p >= 0.5e0), 0e0), 4) AS avg_attack_probability,
  round(max(p), 4) AS max_attack_probability FROM post"""))
def run_batch(spark, sf_dir):
    """CSV flows through a stored model to CSV predictions; the summary."""
    model, rows = bayes_model(spark, sf_dir)
    root = fresh_folder(spark, "batch")
    models.save_model(spark, model, f"{root}/model", {"model_name": "NB_plain", "strategy": "none"})
    write_csv(rows.select("flow_id", "label", *FEATURES[:4], "pkt_len_std"), f"{root}/flows")
    return jobs.run_batch(spark, f"{root}/flows", f"{root}/model", f"{root}/predictions").drop(
        "timestamp", "input_file")


@query("g4_model_info", with_labeled("""
SELECT 'GaussianNaiveBayes' AS model_type, 'NB_plain' AS model_name, 'none' AS strategy, 3 AS n_features,
  round(avg(is_attack), 9) AS attack_share FROM labeled"""))
def model_info(spark, sf_dir):
    model, rows = bayes_model(spark, sf_dir)
    share = rows.agg(F.avg("is_attack")).first()[0]
    path = fresh_folder(spark, "model")
    models.save_model(spark, model, path, {"model_name": "NB_plain", "strategy": "none",
                                           "metrics": {"attack_share": share}})
    return models.model_info(spark, path).select(
        "model_type", "model_name", "strategy", "n_features", F.round(F.col("metrics")["attack_share"], 9).alias("attack_share"))


@query("c20_smote", with_labeled(f"""
WITH c AS (SELECT is_attack, count(*) AS n FROM labeled WHERE flow_ts < TIMESTAMP '{TRAIN_END}' GROUP BY 1)
SELECT is_attack, false AS is_synthetic, n, n AS n_with_key FROM c
UNION ALL SELECT is_attack, true, (SELECT max(n) FROM c) - n, 0 FROM c WHERE n < (SELECT max(n) FROM c)"""))
def smote_balance(spark, sf_dir):
    """Rows per class, real and synthetic; both classes come out equally large."""
    train, _, _ = parts(spark, sf_dir)
    out = smote(train, "flow_id", "is_attack", FEATURES)
    return out.groupBy("is_attack", "is_synthetic").agg(
        F.count("*").alias("n"), F.count("flow_id").alias("n_with_key"))


@query("c20_smote_blocks", """
WITH c AS (SELECT CAST(label = 0 AS INT) AS is_zero, count(*) AS n FROM embeddings GROUP BY 1)
SELECT is_zero, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS n_synthetic FROM c""")
def smote_blocks(spark, sf_dir):
    """The search in blocks of 16 points: the small class grows to the size of the large one."""
    rows, cols = _vector_rows(spark, sf_dir)
    rows = rows.withColumn("is_zero", (F.col("label") == 0).cast("int"))
    out = smote(rows, "vec_id", "is_zero", cols, block_rows=16)
    return out.groupBy("is_zero").agg(F.count("*").alias("n"), F.count_if("is_synthetic").alias("n_synthetic"))


@query("c20_smote_index", """
WITH c AS (SELECT label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY 1)
SELECT label, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS n_synthetic FROM c""")
def smote_index(spark, sf_dir):
    """All classes of the vectors grown to the largest, with neighbours from the index in 64 columns."""
    rows, cols = _vector_rows(spark, sf_dir)
    out = smote(rows, "vec_id", "label", cols, approximate=True)
    return out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_synthetic").alias("n_synthetic"))


@query("c20_smote_spread")
def smote_spread(spark, sf_dir):
    """Means of real and synthetic attack flows; interpolation keeps them close."""
    train, _, _ = parts(spark, sf_dir)
    out = smote(train, "flow_id", "is_attack", FEATURES).filter(F.col("is_attack") == 1)
    return out.groupBy("is_synthetic").agg(
        F.round(F.avg("flow_duration"), 2).alias("avg_duration"), F.round(F.avg("pkt_len_std"), 4).alias("avg_len_std"))


@query("g1_predict_summary")
def predict_summary(spark, sf_dir):
    """Totals of a class-weighted logistic regression over all flows."""
    rows = balance.with_sample_weight(learn_rows(spark, sf_dir))
    model = models.fit_logistic(rows, FEATURES, weight="weight",
                                scaler=scaling.fit_continuous_scaler(rows, FEATURES))
    return scoring.batch_summary(predict(rows, model))
