"""Every registered query against its check SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import SF, connect, differences

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Fits of several models; they run in test_models on one small table.
SLOW = {"e1_fit_logistic", "e2_fit_random_forest", "e3_fit_gbt", "e3_fit_gbt_validated", "e4_fit_gbt_deep",
        "e5_fit_calibrated_svm", "e6_fit_mlp", "e9_tune", "e9_tune_by_halving", "e10_train_grid"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registry_names():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 110


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in ORACLES:
        assert not differences(con, ORACLES[name], df, rows)


def test_entry(spark):
    assert {r.attack_type for r in entry.entry(spark).collect()} >= {"Benign", "Bot"}


SLICED = ["b6_fit_median", "b10_remove_outliers_iqr", "c20_smote", "d16_running_totals", "f3_roc_auc",
          "f6_rank_metrics_many_scores", "f11_leaderboard", "g8_trailing_sums", "g9_source_context", "s3_with_gap"]


@pytest.mark.parametrize("name", SLICED)
def test_query_in_small_pieces(spark, con, name):
    """The paths large tables take, on small ones: many slices, brackets and blocks."""
    sizes = {"spark.flowlab.rowsPerSlice": "90", "spark.flowlab.gatherRows": "30", "spark.flowlab.blockRows": "40"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        df = QUERIES[name](spark, SF)
        assert not differences(con, ORACLES[name], df, [tuple(r) for r in df.collect()])
    finally:
        for key in sizes:
            spark.conf.unset(key)
