from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.operators import balance, cleaning, scaling, splitting
from flowlab.operators.quantiles import exact_quantiles
from flowlab.operators.running import fit_cuts, previous_value, running_sums

NAN, INF = float("nan"), float("inf")


def test_fill_zero_keeps_or_clears_infinity(frame):
    df = frame([(1.0, 1, "a"), (NAN, None, "b"), (INF, 3, "c"), (4.0, 4, None)], "x double, n bigint, Label string")
    assert [(r.x, r.n) for r in cleaning.fill_missing_zero(df).collect()] == [(1.0, 1), (0.0, 0), (0.0, 3)]
    assert [r.x for r in cleaning.fill_missing_zero(df, inf_as_null=False).collect()] == [1.0, 0.0, INF]


def test_median_matches_interpolation_and_skips_missing(frame):
    df = frame([(1.0,), (2.0,), (4.0,), (7.0,), (NAN,), (None,)], "x double")
    assert cleaning.fit_median(df, ["x"]) == {"x": 3.0}


def test_all_null_and_empty_columns(frame):
    df = frame([(None, "x"), (None, "y")], "n double, t string")
    assert cleaning.fit_median(df, ["n"]) == {"n": None}
    assert [r.t for r in cleaning.coerce_numeric(df, ["t"]).collect()] == [0.0, 0.0]
    empty = df.limit(0)
    assert cleaning.fit_median(empty, ["n"]) == {"n": None}
    assert cleaning.remove_outliers_iqr(empty, ["n"]).count() == 0
    assert cleaning.missing_ratios(empty) == {"n": 0.0, "t": 0.0}
    assert cleaning.duplicate_report(empty).first().asDict() == {"n_rows": 0, "n_distinct": 0, "n_removed": 0}


def test_coerce_fills_bad_text_with_median(frame):
    df = frame([("1",), ("not a complete handshake",), ("5",), (None,), (" 9 ",)], "t string")
    assert [r.t for r in cleaning.coerce_numeric(df, ["t"]).collect()] == [1.0, 5.0, 5.0, 5.0, 9.0]


def test_infinity_becomes_median_of_finite(frame):
    df = frame([(1.0,), (3.0,), (INF,), (-INF,), (NAN,)], "x double")
    assert [r.x for r in cleaning.inf_to_median(df).collect()] == [1.0, 3.0, 2.0, 2.0, 2.0]


def test_duplicates_treat_nan_and_signed_zero_as_equal(frame):
    df = frame([(NAN, 0.0), (NAN, -0.0), (1.0, 0.0)], "a double, b double")
    assert cleaning.drop_duplicates(df).count() == 2


def test_outliers_in_sequence_see_only_kept_rows(frame):
    rows = [(float(i), float(i)) for i in range(20)] + [(1000.0, 5000.0), (None, 3.0)]
    df = frame(rows, "a double, b double")
    assert cleaning.remove_outliers_iqr(df, ["a", "b"]).count() == 20
    assert cleaning.remove_outliers_iqr(df, ["a"], approx=True).count() == 20


@pytest.mark.parametrize("gather", [1, 3, 50, 100_000])
def test_exact_quantiles_on_ties_skew_and_infinity(spark, gather):
    rng = np.random.default_rng(7)
    cols = {
        "normal": rng.normal(size=3000),
        "hot": np.where(rng.random(3000) < 0.4, 5.0, rng.integers(0, 10, 3000)),
        "two": np.repeat([1.0, 2.0], 1500),
        "inf": np.where(rng.random(3000) < 0.01, INF, rng.exponential(size=3000)),
    }
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values(), strict=True)],
                               ", ".join(f"{c} double" for c in cols))
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9]
    found = exact_quantiles(df, {c: points for c in cols}, gather_rows=gather)
    for c, values in cols.items():
        assert found[c] == pytest.approx(np.quantile(values, points).tolist(), rel=1e-12), c


def test_scaler_uses_population_deviation(frame):
    df = frame([(1.0, 3.0, 0), (2.0, 3.0, 1), (4.0, 3.0, 1), (7.0, 3.0, 0)], "x double, c double, b int")
    model = scaling.fit_continuous_scaler(df, ["x", "c", "b"])
    assert model["x"] == pytest.approx((3.5, 2.29128784747792))
    assert model["c"] == (3.0, 1.0) and "b" not in model
    assert [r.c for r in scaling.apply_scaler(df, model).collect()] == [0.0] * 4
    assert scaling.binary_columns(df, ["x", "c", "b"]) == ["b"]


def test_stratified_split_hits_the_quota_in_any_partitioning(spark):
    df = spark.range(5003).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    split = splitting.fit_stratified_split(df, "id", "y")
    again = splitting.fit_stratified_split(df.repartition(7), "id", "y")
    assert split.borders == again.borders
    counts = {r.y: r.n for r in df.filter(split.is_test()).groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == math.ceil(0.2 * 5003)
    assert abs(counts[1] - 0.2 * 501) < 1
    train, test = splitting.stratified_split(df, "id", "y")
    assert train.count() + test.count() == 5003 and train.intersect(test).isEmpty()


def test_stratified_split_of_tiny_classes(frame):
    df = frame([(i, "big" if i else "one") for i in range(11)], "id bigint, y string")
    train, test = splitting.stratified_split(df, "id", "y")
    assert (train.count(), test.count()) == (8, 3)


def test_time_split_is_half_open_and_drops_bad_times(frame):
    df = frame([("2018-02-19 23:59:59",), ("2018-02-20 00:00:00",), ("2018-02-22",), ("x",), (None,)], "Timestamp string")
    assert [p.count() for p in splitting.split_by_time(df)] == [1, 1, 1]


def test_class_weights_of_one_class(frame):
    df = frame([("a",), ("a",), (None,)], "y string")
    assert [tuple(r) for r in balance.class_weights(df, "y").collect()] == [("a", 2, 1.0)]
    ones = frame([(0,), (0,)], "is_attack int")
    assert balance.pos_weight(ones).first().pos_weight is None
    assert [r.weight for r in balance.with_pos_weight(ones).collect()] == [1.0, 1.0]


def hot_rows(spark):
    """A third of the rows under one key, some without a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 7, F.lit(None)).otherwise(F.col("id") % 11)
    return spark.range(3000).select("id", key.cast("bigint").alias("k"), ((F.col("id") * 37) % 1009).alias("t"))


def test_sliced_running_sums_equal_one_window(spark):
    df = hot_rows(spark)
    sums = {"c": F.lit(1), "s": F.col("id")}
    cuts = fit_cuts(df, "t", 100)
    assert len(cuts) > 10
    for by in ([], ["k"]):
        for down in (False, True):
            args = dict(by=by, descending=down, totals={"n": F.lit(1)})
            one = running_sums(df, ["t"], sums, **args)
            many = running_sums(df, ["t"], sums, cuts=cuts, **args)
            assert one.exceptAll(many).isEmpty() and many.count() == 3000


def test_sliced_previous_value_equals_one_window(spark):
    df = hot_rows(spark)
    one = previous_value(df, "t", "id", ["k"], "prev")
    many = previous_value(df, "t", "id", ["k"], "prev", fit_cuts(df, "t", 100))
    assert one.exceptAll(many).isEmpty() and many.count() == 3000


def test_align_adds_drops_and_orders(frame):
    out = cleaning.align_features(frame([(1, 2, 3)], "a int, b int, extra int"), ["b", "new", "a"])
    assert out.columns == ["b", "new", "a"] and tuple(out.first()) == (2, 0, 1)
