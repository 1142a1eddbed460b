from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.operators import metrics, ordering, profile, reports, scoring


def ranked(p: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Brute force: pairwise AUC and step-wise average precision."""
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    ap, last = 0.0, 0
    for t in sorted(set(p), reverse=True):
        hits, called = ((p >= t) & (y == 1)).sum(), (p >= t).sum()
        ap += (hits - last) / len(pos) * hits / called
        last = hits
    return auc, ap


@pytest.fixture
def four(frame):
    return frame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "p double, is_attack int")


def test_four_rows(four):
    row = metrics.rank_metrics(four).first()
    assert row.roc_auc == 0.75 and row.pr_auc == pytest.approx(0.8333333333)


@pytest.mark.parametrize("slices,digits", [(1_000_000, 9), (40, 9), (40, 1), (7, 2)])
def test_rank_metrics_match_brute_force(spark, slices, digits):
    rng = np.random.default_rng(3)
    y = (rng.random(700) < 0.2).astype(int)
    p = np.round(rng.random(700) * 0.7 + y * 0.3, digits)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y, strict=True)], "p double, is_attack int")
    row = metrics.rank_metrics(df, rows_per_slice=slices).first()
    assert (row.roc_auc, row.pr_auc) == pytest.approx(ranked(p, y))


def test_single_class_gives_null(frame):
    row = metrics.rank_metrics(frame([(0.3, 1), (0.4, 1)], "p double, is_attack int")).first()
    assert row.roc_auc is None and row.pr_auc is None


def test_zero_division(frame):
    df = frame([(0, 0), (0, 0)], "is_attack int, prediction int")
    assert metrics.binary_metrics(df).first().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert metrics.error_rates(df).first().asDict() == {"fpr": 0.0, "fnr": 0.0}


def test_evaluate_agrees_with_its_parts_per_run(spark):
    df = spark.range(400).select(
        (F.col("id") % 2).alias("run"), ((F.col("id") * 7919) % 13 < 4).cast("int").alias("is_attack"),
        (((F.col("id") * 31) % 17) / 17.0).alias("p"))
    df = metrics.apply_threshold(df)
    whole = {r.run: r for r in metrics.evaluate(df, by=["run"]).collect()}
    for run in (0, 1):
        part = df.filter(F.col("run") == run)
        assert whole[run].f1 == metrics.binary_metrics(part).first().f1
        assert whole[run].roc_auc == pytest.approx(metrics.roc_auc(part).first().roc_auc)


def test_curves_and_thinning(four):
    points = {r.threshold: (r.precision, r.recall) for r in metrics.pr_curve(four).collect()}
    assert points[0.35] == (pytest.approx(2 / 3), 1.0) and points[0.8] == (1.0, 0.5)
    roc = {r.threshold: (r.fpr, r.tpr) for r in metrics.roc_curve(four).collect()}
    assert roc[0.1] == (1.0, 1.0) and roc[0.4] == (0.5, 0.5)
    assert metrics.roc_curve(four, bins=2).count() == 2
    ends = metrics.roc_curve(four, anchor=True).filter("threshold = double('infinity')").collect()
    assert [(r.fpr, r.tpr) for r in ends] == [(0.0, 0.0)]
    assert metrics.pr_curve(four, anchor=True).count() == 5


def test_report_counts_a_class_that_is_only_predicted(frame):
    df = frame([(0, 0), (0, 2), (1, 1)], "is_attack int, prediction int")
    rows = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert (rows["2"].support, rows["2"].precision) == (0, 0.0)
    assert rows["0"].recall == 0.5 and rows["accuracy"].f1 == pytest.approx(2 / 3)
    assert rows["weighted avg"].support == 3


def runs14(spark):
    metric = {m: 0.5 + 0.05 * i for i, m in enumerate(ordering.FAMILIES)}
    return ordering.metrics_to_rows(spark, {
        f"{m}_{s}": {k: v + (0.03 if s == "SMOTE" else 0.0) for k in reports.METRICS}
        for m, v in metric.items() for s in ordering.STRATEGIES})


def test_comparison_tables(spark):
    board = reports.leaderboard(runs14(spark))
    assert board.first().run == "NB_SMOTE"
    assert reports.best_family(board).first().family == "NB"
    assert reports.recommend_strategy(board).first().recommendation == "SMOTE"
    assert ordering.metric_pivot(board, "f1").count() == 7
    assert {r.better for r in reports.better_strategy(board).collect()} == {"SMOTE"}
    assert [r.run for r in reports.ranking(board).collect()] == ["NB_SMOTE"] * 3


def test_ties_go_to_the_smallest_name(frame):
    df = frame([("b", 0.5), ("a", 0.5), ("c", None)], "run string, f1 double")
    assert reports.select_best(df, "f1").first().run == "a"


def test_histogram_keeps_empty_bins_and_closes_the_last(frame):
    df = frame([(0.0,), (1.0,), (10.0,), (float("nan"),), (float("inf"),)], "x double")
    assert [r.n for r in profile.histogram(df, "x", bins=5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    assert sum(r.n for r in profile.histogram(frame([(3.0,), (3.0,)], "x double"), "x", bins=4).collect()) == 2


def test_summary_of_nothing_is_zero(frame):
    empty = frame([], "attack_probability double, prediction int")
    row = scoring.batch_summary(empty).first()
    assert (row.total_flows, row.attack_rate_percent, row.avg_attack_probability) == (0, 0.0, 0.0)


def test_enrich_honours_the_threshold(frame):
    df = frame([(0.3,), (0.5,), (0.85,)], "attack_probability double")
    rows = scoring.enrich(df, threshold=0.6).collect()
    assert [r.prediction for r in rows] == [0, 0, 1]
    assert [r.confidence for r in rows] == [0.7, 0.5, 0.85]
    assert [r.high_confidence_attack for r in rows] == [False, False, True]


def test_running_totals_in_slices(spark):
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") % 120).alias("ts"), (F.col("id") % 4 == 0).cast("int").alias("prediction"))
    one, many = profile.running_totals(df, "ts"), profile.running_totals(df, "ts", rows_per_slice=20)
    assert one.exceptAll(many).isEmpty() and many.count() == 120
    assert many.agg(F.max("total_flows")).first()[0] == 500


def test_gap_and_interarrival(frame):
    df = frame([(1, 1, 10), (2, 1, 10), (3, 1, 25), (4, None, 5), (5, None, 9)], "id bigint, src bigint, s bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    gaps = {r.id: r.gap_s for r in ordering.with_gap(df, "ts", "src", "id", rows_per_slice=2).collect()}
    assert gaps == {1: None, 2: 0.0, 3: 15.0, 4: None, 5: 4.0}
    assert profile.interarrival_stats(df, "ts").first().mean_gap_s == 5.0


def test_running_totals_with_null_order_do_not_depend_on_slices(spark):
    from pyspark.sql import functions as F

    from flowlab.operators import running

    rows = spark.range(200).select(F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("t"), F.lit(1).alias("one"))
    cuts = running.fit_cuts(rows, "t", 20)
    sliced, plain = (running.running_sums(rows, ["t"], {"n": F.col("one")}, cuts=c).orderBy("t").collect() for c in (cuts, []))
    assert len(cuts) > 3 and [tuple(r) for r in sliced] == [tuple(r) for r in plain]
    assert {r.n for r in sliced if r.t is None} == {20}


@pytest.mark.parametrize("parts", [1, 70])
def test_correlations_in_one_pass(spark, parts):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 30)) + 1e6 * np.arange(30)
    x[:, 1] = 2 * x[:, 0] + 5
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5], x[:, 6] = 3.0, np.nan
    cols = [f"c{i}" for i in range(30)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(parts)
    got = {(r.column_a, r.column_b): r.corr for r in profile.correlation_matrix(df, cols).collect()}
    assert len(got) == 435
    for i, a in enumerate(cols):
        for j in range(i + 1, 30):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            varies = both.sum() > 1 and x[both, i].std() > 0 and x[both, j].std() > 0
            want = np.corrcoef(x[both, i], x[both, j])[0, 1] if varies else None
            assert (got[a, cols[j]] is None) == (want is None) and (want is None or abs(got[a, cols[j]] - want) < 1e-7)
    assert {r.corr for r in profile.correlation_matrix(df.limit(0), cols[:3]).collect()} == {None}
