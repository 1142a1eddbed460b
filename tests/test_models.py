from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlab import models
from flowlab.models import classifiers, search
from flowlab.models.base import predict
from flowlab.models.boosting import SideBySide
from flowlab.models.search import materialize, score_run
from flowlab.operators import balance, scaling
from flowlab.operators.neighbours import _visit, distinct_points, nearest
from flowlab.operators.smote import smote, synthesize
from flowlab.plans import catalog, jobs
from flowlab.session import fresh_folder

FEATURES = [f"feature_{i}" for i in range(4)]


@pytest.fixture(scope="module")
def planted(spark):
    """Two classes, one in eight an attack, apart along the first feature."""
    rng = np.random.default_rng(42)
    y = (np.arange(800) % 8 == 0).astype(int)
    x = rng.normal(size=(800, 4))
    x[:, 0] += 4.0 * y
    rows = [(i, int(c), *map(float, r)) for i, (c, r) in enumerate(zip(y, x, strict=True))]
    df = spark.createDataFrame(rows, "flow_id bigint, is_attack int, " + ", ".join(f"{f} double" for f in FEATURES))
    return materialize(df, "planted")


@pytest.fixture(scope="module")
def weighted(planted):
    return materialize(balance.with_sample_weight(planted), "weighted")


@pytest.mark.parametrize("fit,options", [
    (models.fit_logistic, {"max_iter": 20}),
    (models.fit_random_forest, {"trees": 5, "depth": 4}),
    (models.fit_gbt, {"rounds": 3, "depth": 3}),
    (models.fit_leafwise_gbt, {"rounds": 3, "leaves": 6}),
    (models.fit_calibrated_svm, {"max_iter": 5}),
    (models.fit_mlp, {"layers": (8,), "epochs": 15, "batch": 64, "rate": 0.02}),
    (models.fit_gaussian_nb, {}),
])
@pytest.mark.parametrize("weight", [None, "weight"])
def test_classifiers_separate_a_planted_signal(weighted, fit, options, weight):
    model = fit(weighted, FEATURES, weight=weight, **options)
    scored = predict(weighted, model)
    assert scored.filter("not attack_probability between 0 and 1").isEmpty()
    values = score_run(model, weighted, "is_attack")
    assert values["roc_auc"] > 0.95 and values["pr_auc"] > 0.8
    if weight:
        assert values["recall"] > 0.85


def test_weighted_fit_raises_recall(weighted):
    plain = score_run(models.fit_logistic(weighted, FEATURES, max_iter=20), weighted, "is_attack")
    heavy = score_run(models.fit_logistic(weighted, FEATURES, weight="weight", max_iter=20), weighted, "is_attack")
    assert heavy["recall"] > plain["recall"]


def test_absent_and_extra_columns(planted):
    model = models.fit_gaussian_nb(planted, FEATURES)
    out = predict(planted.drop("feature_3").withColumn("extra", F.lit("x")), model)
    assert out.count() == 800 and "extra" in out.columns
    zero = predict(planted.withColumn("feature_3", F.lit(0.0)), model)
    assert out.select("flow_id", "attack_probability").exceptAll(zero.select("flow_id", "attack_probability")).isEmpty()


def test_stored_model_scores_the_same(spark, planted):
    scaler = scaling.fit_scaler(planted, FEATURES)
    model = models.fit_calibrated_svm(planted, FEATURES, scaler=scaler, max_iter=3)
    path = fresh_folder(spark, "model")
    models.save_model(spark, model, path, {"model_name": "SVM_plain", "metrics": {"f1": 0.5}, "note": 1})
    again = models.load_model(spark, path)
    assert again.meta["model_name"] == "SVM_plain" and again.meta["note"] == 1
    a, b = (predict(planted, m).select("flow_id", "attack_probability") for m in (model, again))
    assert a.exceptAll(b).isEmpty()
    assert models.model_info(spark, path).first().n_features == 4


def test_grid_log_and_best_model(spark, planted):
    out, log = fresh_folder(spark, "grid"), fresh_folder(spark, "log")
    board, model = jobs.train_best(planted, planted, out, FEATURES, "flow_id", families=("LR", "NB"),
                                   options={"LR": {"max_iter": 5}}, run_log=log)
    assert {r.run for r in board.collect()} == {"LR_SMOTE", "LR_Weighted", "NB_SMOTE", "NB_Weighted"}
    assert board.first().run == model.meta["model_name"]
    runs = models.read_runs(spark, log)
    assert runs.count() == 4 and runs.agg(F.min("roc_auc")).first()[0] > 0.9
    assert jobs.evaluate_saved(spark, f"{out}/best_model", planted)["roc_auc"] > 0.9
    assert set(jobs.compare_runs(board)["by_family"].toPandas()["family"]) == {"LR", "NB"}


def test_search_is_seeded(planted):
    space = {"max_depth": ("int", 2, 3), "learning_rate": ("log", 0.05, 0.3), "n_estimators": ("int", 1, 2),
             "subsample": ("float", 0.8, 1.0), "colsample_bytree": ("float", 0.8, 1.0), "gamma": ("float", 0, 0),
             "min_child_weight": ("int", 1, 2), "reg_alpha": ("float", 0, 1), "reg_lambda": ("float", 0, 1)}
    trials, model = models.tune(planted, planted, FEATURES, space=space, n=2)
    again, _ = models.tune(planted, planted, FEATURES, space=space, n=2)
    key = lambda r: (r.trial, r.pr_auc, sorted(r.params.items()))
    assert list(map(key, trials.collect())) == list(map(key, again.collect()))
    top = models.feature_importance(model, planted.sparkSession, 2).collect()
    assert top[0].feature == "feature_0" and len(top) == 2


def test_points_of_the_default_space_split(planted):
    """The least gain drawn as gamma must leave most trials a tree that splits."""
    rng = random.Random(search.SEED)
    points = [search.growth_of(search.draw(search.SPACE, rng), 42) for _ in range(5)]
    boosts = SideBySide(planted, FEATURES, points)
    boosts.advance({p: 1 for p in range(5)})
    assert sum(len(e.trees[0].feature) > 1 for e in boosts.ensembles) >= 4


def test_halving_finds_the_best_point(planted):
    """On a planted table the point that learns at all wins either way, with fewer rounds in all."""
    space = {"max_depth": ("int", 2, 4), "learning_rate": ("log", 0.0001, 0.5), "n_estimators": ("int", 4, 8),
             "subsample": ("float", 1, 1), "colsample_bytree": ("float", 1, 1), "gamma": ("float", 0, 400),
             "min_child_weight": ("int", 1, 2), "reg_alpha": ("float", 0, 1), "reg_lambda": ("float", 0, 1)}
    noisy = planted.withColumn("feature_0", F.col("feature_0") * 0.3 + F.col("feature_1"))
    train, val = noisy.filter("flow_id % 3 > 0"), noisy.filter("flow_id % 3 = 0")
    full, best = models.tune(train, val, FEATURES, space=space, n=8)
    halved, again = models.tune_by_halving(train, val, FEATURES, space=space, n=8, rungs=3)
    assert best.meta["params"] == again.meta["params"] and best.meta["metrics"] == again.meta["metrics"]
    rounds = [sum(r.rounds for r in t.collect()) for t in (full, halved)]
    assert rounds[1] < rounds[0] and halved.count() == 8


@pytest.mark.parametrize("fit,options", [(models.fit_gbt, {"rounds": 2}), (models.fit_leafwise_gbt, {"rounds": 2}),
                                         (models.fit_mlp, {"epochs": 1, "layers": (5, 3)})])
def test_stored_arrays_score_the_same(spark, planted, fit, options):
    scaler = scaling.fit_scaler(planted, FEATURES)
    model = fit(planted, FEATURES, scaler=scaler, **options)
    path = fresh_folder(spark, "model")
    models.save_model(spark, model, path, {"model_name": "GBT"})
    again = models.load_model(spark, path)
    a, b = (predict(planted, m).select("flow_id", "attack_probability") for m in (model, again))
    assert a.exceptAll(b).isEmpty() and again.meta["model_type"] == model.meta["model_type"]
    assert "stored_as" not in again.meta and again.features == FEATURES


def test_synthetic_rows_are_named_by_base_and_copy(planted):
    keys = lambda df: {(r.base_key, r.copy) for r in smote(df, "flow_id", "is_attack", FEATURES, with_origin=True)
                       .filter("is_synthetic").select("base_key", "copy").collect()}
    few = planted.filter("is_attack = 0 OR flow_id % 3 = 0")
    named = keys(few)
    made = smote(few, "flow_id", "is_attack", FEATURES).filter("is_synthetic").count()
    assert named == keys(few.repartition(5)) and len(named) == made > 0


@pytest.mark.parametrize("name", ["e3_fit_gbt", "e3_fit_gbt_validated", "e4_fit_gbt_deep", "e5_fit_calibrated_svm",
                                  "e6_fit_mlp", "e9_tune", "e9_tune_by_halving", "e10_train_grid", "e12_save_model"])
def test_queries_fit_at_the_default_sizes(spark, sf, monkeypatch, name):
    class Called(Exception):
        pass

    def record(*_, **options):
        raise Called(options)

    for at in ("fit_gbt", "fit_leafwise_gbt", "fit_calibrated_svm", "fit_mlp", "tune", "tune_by_halving"):
        monkeypatch.setattr(models, at, record)
    monkeypatch.setattr(jobs, "train_best", record)
    catalog.load_all()
    with pytest.raises(Called) as called:
        catalog.QUERIES[name](spark, sf)
    sizes = {"rounds", "max_iter", "layers", "epochs", "batch", "space", "n", "options", "depth", "leaves", "rungs", "keep"}
    assert not sizes & set(called.value.args[0])


def test_isolation_forest_in_any_partitioning(spark, planted):
    fit = lambda df: models.fit_isolation_forest(df, "flow_id", FEATURES, trees=20, psi=64)
    forest, again = fit(planted), fit(planted.repartition(5))
    assert forest.nodes.equals(again.nodes) and forest.offset == again.offset
    out = models.score_isolation_forest(planted, forest)
    rows = out.groupBy("prediction").agg(F.count("*").alias("n")).collect()
    assert {r.prediction: r.n for r in rows} == {0: 720, 1: 80}
    path = fresh_folder(spark, "forest")
    models.save_forest(spark, forest, path)
    same = models.score_isolation_forest(planted, models.load_forest(spark, path))
    assert out.exceptAll(same).isEmpty()


def test_isolation_forest_finds_far_points(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(500, 2)), rng.normal(size=(5, 2)) + 12])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id bigint, a double, b double")
    forest = models.fit_isolation_forest(df, "id", ["a", "b"], trees=50, contamination=0.02)
    top = models.score_isolation_forest(df, forest).orderBy(F.desc("anomaly_score")).limit(5).collect()
    assert {r.id for r in top} == set(range(500, 505))


def brute(x: np.ndarray, k: int) -> list[list[float]]:
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k].tolist()


@pytest.mark.parametrize("block", [16, 10_000])
def test_neighbours_match_brute_force_with_a_third_copies(spark, block):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 3))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "id bigint, v array<double>")
    points = nearest(distinct_points(df, "v"), 5, block).collect()
    distance = {tuple(r.v): r for r in points}
    assert sum(r.m for r in points) == 240
    for row, want in zip(x, brute(x, 5), strict=True):
        r = distance[tuple(map(float, row))]
        have = [0.0] * (r.m - 1) + [f.d for f in r.found for _ in range(f.m)]
        assert have[:5] == pytest.approx(want, abs=1e-9)


def test_synthetic_rows_lie_between_near_rows(spark, planted):
    attacks = planted.filter("is_attack = 1").select("flow_id", F.array(*FEATURES).alias("v"))
    x = {tuple(r.v): r.flow_id for r in attacks.collect()}
    points = np.array(list(x))
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    for block in (10_000, 16):
        made = synthesize(attacks, "flow_id", "v", 100, 333, block_rows=block).collect()
        assert len(made) == 333
        per_base = {}
        for r in made:
            assert x[tuple(r.base)] == r.key and tuple(r.other) in x
            i, j = (list(x).index(tuple(v)) for v in (r.base, r.other))
            assert (d[i] < d[i][j]).sum() <= 5
            a, b, s = map(np.array, (r.base, r.other, r.x))
            assert np.linalg.norm(a - s) + np.linalg.norm(s - b) == pytest.approx(np.linalg.norm(a - b))
            per_base[r.key] = per_base.get(r.key, 0) + 1
        assert set(per_base.values()) == {3, 4} and len(per_base) == 100


def test_smote_balances_and_keeps_the_originals(planted):
    out = smote(planted, "flow_id", "is_attack", FEATURES)
    again = smote(planted.repartition(5), "flow_id", "is_attack", FEATURES)
    assert out.exceptAll(again).isEmpty()
    assert {r.n for r in out.groupBy("is_attack").agg(F.count("*").alias("n")).collect()} == {700}
    real = out.filter("not is_synthetic").select(*planted.columns)
    assert real.exceptAll(planted).isEmpty() and real.count() == 800


def test_batch_job(spark, planted, tmp_path):
    model = models.fit_gaussian_nb(planted, FEATURES)
    models.save_model(spark, model, f"{tmp_path}/m", {"model_name": "NB"})
    from flowlab.sources import write_csv

    write_csv(planted.withColumn("note", F.lit("a b")), f"{tmp_path}/in")
    row = jobs.run_batch(spark, f"{tmp_path}/in", f"{tmp_path}/m", f"{tmp_path}/out").first()
    assert (row.total_flows, row.model_name) == (800, "NB")
    assert row.attacks_detected + row.benign_flows == 800


def test_forest_deals_a_large_table_evenly(spark, planted, monkeypatch):
    """All rows of a table in one part reach as many parts as there are cores, the same ones again; a small table stays as it is."""
    rows = classifiers._training(planted.coalesce(1), FEATURES, "is_attack", None, None)
    assert classifiers._spread(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(classifiers, "FOREST_ROWS", 100)
    dealt = [classifiers._spread(rows).rdd.glom().collect() for _ in range(2)]
    assert [len(part) for part in dealt[0]] == [200] * 4 and dealt[0] == dealt[1]
    monkeypatch.setattr(classifiers, "FOREST_PART_ROWS", 70)
    again = classifiers._spread(rows)
    assert again.rdd.getNumPartitions() == 12 and again.count() == 800 and again.exceptAll(rows).isEmpty()
    model = models.fit_random_forest(planted.coalesce(1), FEATURES, trees=5, depth=4)
    assert score_run(model, planted, "is_attack")["roc_auc"] > 0.95


def test_a_visit_returns_only_points_within_reach():
    """Of another block only what can enter a list leaves a task, nearest first, up to k rows by count."""
    base = pa.table({"p": [1, 2, 3, 4], "m": [1, 2, 1, 1], "v": [[0.0, 1.0], [0.0, 2.0], [0.0, 3.0], [0.0, 9.0]]})
    queries = pa.table({"qp": [10, 11, 3], "qv": [[0.0, 0.0], [0.0, 20.0], [0.0, 3.0]], "qr": [2.0, 5.0, float("inf")]})
    got = {r["p"]: [(f["p"], f["d"], f["m"], f["v"]) for f in r["found"]] for r in _visit(3)(queries, base).to_pylist()}
    assert got == {10: [(1, 1.0, 1, [0.0, 1.0]), (2, 2.0, 2, [0.0, 2.0])], 3: [(2, 1.0, 2, [0.0, 2.0]), (1, 2.0, 1, [0.0, 1.0])]}
    assert _visit(3)(queries, base.slice(0, 0)).schema.equals(_visit(3)(queries, base).schema)
