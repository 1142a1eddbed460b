"""Queries over the evaluation, comparison and enrichment operators.

``runs`` are fourteen score columns over the labeled flows, two per model family, so that the
comparison operators work on metrics computed from the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.operators import cleaning, metrics, ordering, reports, scoring
from flowlab.plans.catalog import query
from flowlab.plans.flows import with_labeled, with_scored
from flowlab.plans.queries_clean import labeled

# Score per family as SQL over labeled flows; the second strategy squares the score.
FAMILY_SCORES = {
    "LR": "tot_fwd_pkts / 100e0",
    "RF": "tot_bwd_pkts / 13e0",
    "XGB": "(tot_fwd_pkts % 10) / 10e0",
    "LGB": "(tot_fwd_pkts % 7 + tot_bwd_pkts % 3) / 10e0",
    "SVM": "syn_flag_cnt / 4e0",
    "MLP": "(fin_flag_cnt + syn_flag_cnt) / 6e0",
    "NB": "(100 - tot_fwd_pkts) / 101e0",
}
RUN_SCORES = {f"{m}_{s}": (e if s == "SMOTE" else f"({e}) * ({e})")
              for m, e in FAMILY_SCORES.items() for s in ("SMOTE", "Weighted")}


def scored(spark, sf_dir):
    return labeled(spark, sf_dir).selectExpr(
        "flow_id", "flow_ts", "src_id", "attack_type", "is_attack", "tot_fwd_pkts / 100e0 AS p",
        "CASE WHEN tot_fwd_pkts / 100e0 >= 0.5e0 THEN 1 ELSE 0 END AS prediction")


def run_rows(spark, sf_dir):
    """One row per run and flow."""
    cells = ", ".join(f"named_struct('run', '{r}', 'p', {e})" for r, e in RUN_SCORES.items())
    rows = labeled(spark, sf_dir).selectExpr("is_attack", f"inline(array({cells}))")
    return metrics.apply_threshold(rows, "p")


def run_board(spark, sf_dir):
    return metrics.evaluate(run_rows(spark, sf_dir), by=["run"])


METRIC_NAMES = list(reports.METRICS)

RUNS_SQL = "run_rows AS (" + " UNION ALL ".join(
    f"SELECT '{r}' AS run, is_attack, {e} AS p FROM labeled" for r, e in RUN_SCORES.items()) + """),
run_at AS (SELECT run, p, count(*) FILTER (is_attack = 1) AS tp, count(*) FILTER (is_attack = 0) AS fp
  FROM run_rows GROUP BY 1, 2),
run_cum AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp FROM run_at
  WINDOW w AS (PARTITION BY run ORDER BY p DESC)),
run_cells AS (SELECT run, count(*) FILTER (is_attack = 1 AND p >= 0.5e0) AS tp,
  count(*) FILTER (is_attack = 0 AND p >= 0.5e0) AS fp, count(*) FILTER (is_attack = 1 AND p < 0.5e0) AS fn,
  count(*) FILTER (is_attack = 0 AND p < 0.5e0) AS tn FROM run_rows GROUP BY 1),
run_rank AS (SELECT run, sum(fp * (ctp - tp / 2e0)) / (sum(tp) * sum(fp)) AS roc_auc,
  sum(tp * CAST(ctp AS DOUBLE) / (ctp + cfp)) / sum(tp) AS pr_auc FROM run_cum GROUP BY 1),
board AS (SELECT run, split_part(run, '_', 1) AS family, split_part(run, '_', 2) AS strategy,
  (tp + tn) * 1e0 / (tp + tn + fp + fn) AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp * 1e0 / (tp + fp) ELSE 0e0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp * 1e0 / (tp + fn) ELSE 0e0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1, roc_auc, pr_auc
  FROM run_cells JOIN run_rank USING (run))"""


def with_board(sql: str) -> str:
    return with_labeled(f"WITH {RUNS_SQL} {sql.strip()}")


def rounded(df, cols, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def round_sql(cols, digits=9):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


CELLS_SQL = """cells AS (SELECT count(*) FILTER (is_attack = 0 AND prediction = 0) AS tn,
  count(*) FILTER (is_attack = 0 AND prediction = 1) AS fp, count(*) FILTER (is_attack = 1 AND prediction = 0) AS fn,
  count(*) FILTER (is_attack = 1 AND prediction = 1) AS tp FROM scored)"""
CUM_SQL = """at_p AS (SELECT p, count(*) FILTER (is_attack = 1) AS tp, count(*) FILTER (is_attack = 0) AS fp
  FROM scored GROUP BY p),
cum AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp, sum(tp) OVER () AS n_pos, sum(fp) OVER () AS n_neg
  FROM at_p WINDOW w AS (ORDER BY p DESC))"""


@query("f1_confusion", with_scored(f"WITH {CELLS_SQL} SELECT * FROM cells"))
def confusion(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir))


@query("f2_binary_metrics", with_scored(f"""WITH {CELLS_SQL}
SELECT round((tp + tn) * 1e0 / (tp + tn + fp + fn), 9) AS accuracy, round(tp * 1e0 / (tp + fp), 9) AS precision,
  round(tp * 1e0 / (tp + fn), 9) AS recall, round(2e0 * tp / (2 * tp + fp + fn), 9) AS f1 FROM cells"""))
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(scored(spark, sf_dir)), ("accuracy", "precision", "recall", "f1"))


@query("f3_roc_auc", with_scored(f"""WITH {CUM_SQL}
SELECT round(sum(fp * (ctp - tp / 2e0)) / (sum(tp) * sum(fp)), 9) AS roc_auc FROM cum"""))
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored(spark, sf_dir)), ["roc_auc"])


@query("f4_average_precision", with_scored(f"""WITH {CUM_SQL}
SELECT round(sum(tp * CAST(ctp AS DOUBLE) / (ctp + cfp)) / sum(tp), 9) AS pr_auc FROM cum"""))
def average_precision(spark, sf_dir):
    return rounded(metrics.average_precision(scored(spark, sf_dir)), ["pr_auc"])


@query("f5_pr_curve", with_scored(f"""WITH {CUM_SQL}
SELECT p AS threshold, round(CAST(ctp AS DOUBLE) / (ctp + cfp), 9) AS precision,
  round(CAST(ctp AS DOUBLE) / n_pos, 9) AS recall FROM cum"""))
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(scored(spark, sf_dir)), ("precision", "recall"))


@query("f6_roc_curve", with_scored(f"""WITH {CUM_SQL}
SELECT p AS threshold, round(CAST(cfp AS DOUBLE) / n_neg, 9) AS fpr,
  round(CAST(ctp AS DOUBLE) / n_pos, 9) AS tpr FROM cum"""))
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(scored(spark, sf_dir)), ("fpr", "tpr"))


@query("f6_rank_metrics_many_scores", with_labeled("""
WITH s AS (SELECT is_attack, totlen_fwd_pkts + flow_id / 1e6 AS p FROM labeled),
a AS (SELECT p, count(*) FILTER (is_attack = 1) AS tp, count(*) FILTER (is_attack = 0) AS fp FROM s GROUP BY p),
cum AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp FROM a WINDOW w AS (ORDER BY p DESC))
SELECT round(sum(fp * (ctp - tp / 2e0)) / (sum(tp) * sum(fp)), 9) AS roc_auc,
  round(sum(tp * CAST(ctp AS DOUBLE) / (ctp + cfp)) / sum(tp), 9) AS pr_auc FROM cum"""))
def rank_metrics_many_scores(spark, sf_dir):
    """Nearly all scores differ, so the ordering runs in slices of a twentieth of the rows."""
    df = labeled(spark, sf_dir).selectExpr("is_attack", "totlen_fwd_pkts + flow_id / 1e6 AS p")
    return rounded(metrics.rank_metrics(df, rows_per_slice=max(1, df.count() // 20)), ("roc_auc", "pr_auc"))


@query("f7_error_rates", with_scored(f"""WITH {CELLS_SQL}
SELECT round(fp * 1e0 / (fp + tn), 9) AS fpr, round(fn * 1e0 / (fn + tp), 9) AS fnr FROM cells"""))
def error_rates(spark, sf_dir):
    return rounded(metrics.error_rates(scored(spark, sf_dir)), ("fpr", "fnr"))


@query("f8_classification_report", with_scored("""
WITH k AS (SELECT DISTINCT is_attack AS c FROM scored),
r AS (SELECT c, count(*) FILTER (is_attack = c) AS support, count(*) FILTER (prediction = c) AS called,
  count(*) FILTER (is_attack = c AND prediction = c) AS hits FROM scored, k GROUP BY c),
m AS (SELECT CAST(c AS VARCHAR) AS class, hits, support,
  CASE WHEN called > 0 THEN hits * 1e0 / called ELSE 0e0 END AS precision,
  CASE WHEN support > 0 THEN hits * 1e0 / support ELSE 0e0 END AS recall,
  2e0 * hits / (called + support) AS f1 FROM r)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM m
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
  CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', round(sum(hits) * 1e0 / sum(support), 9), round(sum(hits) * 1e0 / sum(support), 9),
  round(sum(hits) * 1e0 / sum(support), 9), CAST(sum(support) AS BIGINT) FROM m"""))
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(scored(spark, sf_dir)), ("precision", "recall", "f1"))


@query("f9_accuracy_by_type", with_scored("""
SELECT attack_type, count(*) AS n, round(avg(CASE WHEN is_attack = prediction THEN 1e0 ELSE 0e0 END), 9) AS accuracy
FROM scored GROUP BY attack_type"""))
def accuracy_by_type(spark, sf_dir):
    return rounded(metrics.accuracy_by_type(scored(spark, sf_dir)), ["accuracy"])


@query("f11_leaderboard", with_board(f"SELECT run, family, strategy, {round_sql(METRIC_NAMES)} FROM board"))
def leaderboard(spark, sf_dir):
    return rounded(reports.leaderboard(run_board(spark, sf_dir)), METRIC_NAMES)


@query("f12_mean_by_strategy", with_board(
    f"SELECT strategy, {', '.join(f'round(avg({m}), 9) AS {m}' for m in METRIC_NAMES)} FROM board GROUP BY strategy"))
def mean_by_strategy(spark, sf_dir):
    board = reports.leaderboard(run_board(spark, sf_dir))
    return rounded(reports.mean_by(board, "strategy"), METRIC_NAMES)


@query("f12_mean_by_family", with_board(
    f"SELECT family, {', '.join(f'round(avg({m}), 9) AS {m}' for m in METRIC_NAMES)} FROM board GROUP BY family"))
def mean_by_family(spark, sf_dir):
    board = reports.leaderboard(run_board(spark, sf_dir))
    return rounded(reports.mean_by(board, "family"), METRIC_NAMES)


@query("f12_best_family", with_board("""
SELECT 'pr_auc' AS criterion, family, round(v, 9) AS value FROM
  (SELECT family, avg(pr_auc) AS v FROM board GROUP BY family) b ORDER BY v DESC, family LIMIT 1"""))
def best_family(spark, sf_dir):
    return rounded(reports.best_family(reports.leaderboard(run_board(spark, sf_dir))), ["value"])


@query("f13_recommend_strategy", with_board("""
WITH a AS (SELECT avg(pr_auc) FILTER (strategy = 'SMOTE') AS s, avg(pr_auc) FILTER (strategy = 'Weighted') AS w
  FROM board)
SELECT round(s, 9) AS smote_avg, round(w, 9) AS weighted_avg, CASE WHEN w > s * 1.02e0 THEN 'Weighted'
  WHEN s > w * 1.02e0 THEN 'SMOTE' ELSE 'similar' END AS recommendation FROM a""".replace("WITH a", ", a").strip()))
def recommend_strategy(spark, sf_dir):
    board = reports.leaderboard(run_board(spark, sf_dir))
    return rounded(reports.recommend_strategy(board), ("smote_avg", "weighted_avg"))


@query("f13_better_strategy", with_board("""
SELECT family, round(max(pr_auc) FILTER (strategy = 'SMOTE'), 6) AS smote,
  round(max(pr_auc) FILTER (strategy = 'Weighted'), 6) AS weighted,
  CASE WHEN round(max(f1) FILTER (strategy = 'SMOTE'), 9) > round(max(f1) FILTER (strategy = 'Weighted'), 9)
    THEN 'SMOTE' ELSE 'Weighted' END AS better_f1 FROM board GROUP BY family"""))
def better_strategy(spark, sf_dir):
    board = reports.leaderboard(run_board(spark, sf_dir))
    by_auc = rounded(reports.better_strategy(board), ("smote", "weighted"), 6).drop("better")
    by_f1 = reports.better_strategy(rounded(board, ["f1"]), "f1").select("family", F.col("better").alias("better_f1"))
    return by_auc.join(by_f1, "family")


@query("f14_metric_alerts", with_scored(f"""WITH {CELLS_SQL}
SELECT round(fp * 1e0 / (fp + tn), 9) AS fpr, round(fn * 1e0 / (fn + tp), 9) AS fnr,
  fn * 1e0 / (fn + tp) > 0.1e0 AS high_fnr, fp * 1e0 / (fp + tn) > 0.05e0 AS high_fpr FROM cells"""))
def metric_alerts(spark, sf_dir):
    return rounded(metrics.metric_alerts(metrics.error_rates(scored(spark, sf_dir))), ("fpr", "fnr"))


@query("f15_apply_threshold", with_scored(
    "SELECT flow_id, CASE WHEN p >= 0.3e0 THEN 1 ELSE 0 END AS prediction FROM scored"))
def apply_threshold(spark, sf_dir):
    return metrics.apply_threshold(scored(spark, sf_dir), "p", 0.3).select("flow_id", "prediction")


SWEEP = [0.1, 0.3, 0.5, 0.7, 0.9]


@query("f15_threshold_sweep", with_scored(f"""
SELECT t AS threshold, round(CASE WHEN tp + fp > 0 THEN tp * 1e0 / (tp + fp) ELSE 0e0 END, 9) AS precision,
  round(tp * 1e0 / (tp + fn), 9) AS recall, round(2e0 * tp / (2 * tp + fp + fn), 9) AS f1
FROM (SELECT t, count(*) FILTER (is_attack = 1 AND p >= t) AS tp, count(*) FILTER (is_attack = 0 AND p >= t) AS fp,
  count(*) FILTER (is_attack = 1 AND p < t) AS fn
  FROM scored, (VALUES {', '.join(f'({t}e0)' for t in SWEEP)}) v(t) GROUP BY t) c"""))
def threshold_sweep(spark, sf_dir):
    return rounded(metrics.threshold_sweep(scored(spark, sf_dir), SWEEP), ("precision", "recall", "f1"))


@query("s4_best_by", with_board("""
SELECT 'pr_auc' AS criterion, run, round(pr_auc, 9) AS value FROM
  (SELECT * FROM board ORDER BY round(pr_auc, 9) DESC, run LIMIT 1) b"""))
def best_by(spark, sf_dir):
    return ordering.best_by(rounded(run_board(spark, sf_dir), ["pr_auc"]), "pr_auc")


@query("s4_ranking", with_board(" UNION ALL ".join(f"""
SELECT '{m}' AS criterion, run, round({m}, 9) AS value FROM
  (SELECT * FROM board ORDER BY round({m}, 9) DESC, run LIMIT 1) b_{m}""" for m in reports.CRITERIA)))
def ranking(spark, sf_dir):
    return reports.ranking(rounded(run_board(spark, sf_dir), reports.CRITERIA))


@query("s5_metric_pivot", with_board("""
SELECT family, round(max(pr_auc) FILTER (strategy = 'SMOTE'), 9) AS "SMOTE",
  round(max(pr_auc) FILTER (strategy = 'Weighted'), 9) AS "Weighted" FROM board GROUP BY family"""))
def metric_pivot(spark, sf_dir):
    board = reports.leaderboard(run_board(spark, sf_dir))
    return rounded(ordering.metric_pivot(board, "pr_auc"), ("SMOTE", "Weighted"))


@query("s6_parse_run_name", with_labeled("""
SELECT family, strategy, count(*) AS n FROM (
  SELECT CASE src_id % 4 WHEN 0 THEN 'LR' WHEN 1 THEN 'XGB' WHEN 2 THEN 'NB' END AS family,
    CASE src_id % 3 WHEN 0 THEN 'SMOTE' WHEN 1 THEN 'Weighted' END AS strategy FROM labeled) t GROUP BY 1, 2"""))
def parse_run_name(spark, sf_dir):
    name = ("concat(CASE src_id % 4 WHEN 0 THEN 'lr' WHEN 1 THEN 'XGB' WHEN 2 THEN 'Nb' ELSE 'other' END, '_', "
            "CASE src_id % 3 WHEN 0 THEN 'Smote' WHEN 1 THEN 'weighted' ELSE 'plain' END) AS run")
    parsed = ordering.parse_run_name(labeled(spark, sf_dir).selectExpr(name))
    return parsed.groupBy("family", "strategy").agg(F.count("*").alias("n"))


@query("s7_metrics_long", with_board(" UNION ALL ".join(
    f"SELECT run, '{m}' AS metric, round({m}, 9) AS value FROM board" for m in METRIC_NAMES)))
def metrics_long(spark, sf_dir):
    return rounded(ordering.metrics_long(run_board(spark, sf_dir), "run", METRIC_NAMES), ["value"])


@query("e11_select_best", with_board("""
SELECT 'f1' AS criterion, run, round(f1, 9) AS value FROM
  (SELECT * FROM board ORDER BY round(f1, 9) DESC, run LIMIT 1) b"""))
def select_best(spark, sf_dir):
    return reports.select_best(rounded(run_board(spark, sf_dir), ["f1"]), "f1")


@query("g2_enrich", with_scored("""
SELECT flow_id, p AS attack_probability, CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN p >= 0.5e0 THEN 'attack' ELSE 'benign' END AS prediction_label, greatest(p, 1e0 - p) AS confidence,
  p >= 0.8e0 AS high_confidence_attack FROM scored"""))
def enrich(spark, sf_dir):
    return scoring.enrich(scored(spark, sf_dir), "p").select(
        "flow_id", "attack_probability", "prediction", "prediction_label", "confidence", "high_confidence_attack")


@query("b15_filter_attacks", with_scored("SELECT flow_id, p FROM scored WHERE prediction = 1 AND p >= 0.8e0"))
def filter_attacks(spark, sf_dir):
    return cleaning.filter_attacks(scored(spark, sf_dir), 0.8, prob="p").select("flow_id", "p")
