"""Profiling: counts, shares, correlations, histograms, summaries. Long tables, one scan each."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions import finite, is_missing, present
from flowlab.operators.running import fit_cuts, order_value, running_sums

COLUMNS_PER_JOB = 100
BLOCK_FAN_IN = 32


def long_aggregate(
    df: DataFrame, cols: Sequence[str], measures: Mapping[str, Callable[[str], Column]]
) -> DataFrame:
    """One row per column with the measures as fields; a hundred columns share one scan."""
    parts = []
    for i in range(0, len(cols), COLUMNS_PER_JOB):
        cells = [F.struct(F.lit(c).alias("column_name"), *[f(c).alias(m) for m, f in measures.items()])
                 for c in cols[i:i + COLUMNS_PER_JOB]]
        parts.append(df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))
    return reduce(DataFrame.unionByName, parts)


def quality_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows of the table, columns of the table, nulls."""
    return long_aggregate(df, list(cols or df.columns), {
        "n_rows": lambda c: F.count("*"),
        "n_columns": lambda c: F.lit(len(df.columns)),
        "n_null": lambda c: F.count_if(F.col(c).isNull()),
    })


def missing_percent(df: DataFrame, top: int = 20, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of missing values in percent, highest first, columns with none left out."""
    shares = long_aggregate(df, list(cols or df.columns), {
        "missing_pct": lambda c: F.avg(is_missing(df, c).cast("double")) * 100.0,
    })
    return (shares.filter(F.col("missing_pct") > 0)
            .orderBy(F.col("missing_pct").desc(), "column_name").limit(top))


def label_distribution(df: DataFrame, label: str = "Label") -> DataFrame:
    """Rows per label, most frequent first."""
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(label))


def label_share(df: DataFrame, label: str = "Label") -> DataFrame:
    """Rows and percentage per non-null label."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(label, "n", (F.col("n") * 100.0 / total).alias("share_pct"))


def imbalance_ratio(df: DataFrame, label: str = "Label") -> DataFrame:
    """Largest and smallest class and their ratio."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n").alias("n_largest"), F.min("n").alias("n_smallest"),
                      (F.max("n") / F.min("n")).alias("imbalance_ratio"))


def comoments(x: np.ndarray) -> np.ndarray:
    """Per pair of columns, over rows where both are there: rows, the first column's mean and its squares around that, and
    the products around both means. NaN is missing. The second column's are the transposes of the first's."""
    there = ~np.isnan(x)
    m = there.astype(float)
    with np.errstate(invalid="ignore"):
        middle = np.where(m.sum(axis=0) > 0, np.where(there, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1), 0.0)
    x = np.where(there, x - middle, 0.0)  # near their means, so that little is lost below
    n, s, q, p = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
    mean = s / np.maximum(n, 1)
    return np.stack([n, mean + middle[:, None], q - mean * s, p - mean * s.T])


def merged_comoments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two sets of rows together."""
    n = a[0] + b[0]
    share = a[0] * b[0] / np.maximum(n, 1)
    off = b[1] - a[1]
    mean = np.where(n > 0, (a[0] * a[1] + b[0] * b[1]) / np.maximum(n, 1), 0.0)
    return np.stack([n, mean, a[2] + b[2] + off * off * share, a[3] + b[3] + off * off.T * share])


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of columns, over rows where both are present; null for fewer than two such rows
    and where a column does not vary.

    One scan: tasks sum mergeable blocks of counts, means and products over Arrow batches, which meet in a tree.
    """
    k, schema = len(cols), "at bigint, v binary"
    data = df.select(F.array(*[F.coalesce(present(df, c).cast("double"), F.lit(float("nan"))) for c in cols]).alias("x"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((4, k, k))
        for batch in batches:
            if len(batch):
                total = merged_comoments(total, comoments(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()])], ["at", "v"])

    def met(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")  # in one order, whoever came first
        total = reduce(merged_comoments, (
            np.frombuffer(v).reshape(4, k, k) for v in group.column("v").to_pylist() if v), np.zeros((4, k, k)))
        return pa.table([[max(group.column("at")[0].as_py(), 0) // BLOCK_FAN_IN], pa.array([total.tobytes()])], ["at", "v"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v in batch.column("v").to_pylist():
                n, _, q, p = np.frombuffer(v).reshape(4, k, k)
                i, j = np.triu_indices(k, 1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    corr = np.clip(p[i, j] / np.sqrt(q[i, j] * q.T[i, j]), -1, 1)
                known = (n[i, j] > 1) & np.isfinite(corr)
                yield pa.RecordBatch.from_arrays([pa.array([cols[a] for a in i], pa.string()), pa.array([cols[b] for b in j], pa.string()),
                                                  pa.array(corr, pa.float64(), mask=~known)], ["column_a", "column_b", "corr"])

    nothing = df.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("at"), F.lit(b"").alias("v"))
    parts, left = data.mapInArrow(blocks, schema).unionByName(nothing), df.rdd.getNumPartitions() + 2
    while left > 1:
        parts = parts.groupBy(F.floor(F.greatest("at", F.lit(0)) / BLOCK_FAN_IN)).applyInArrow(met, schema)
        left = -(-left // BLOCK_FAN_IN)
    return parts.mapInArrow(pairs, "column_a string, column_b string, corr double")


def histogram(
    df: DataFrame, value: str, by: str | None = None, bins: int = 50,
    limits: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width bins shared by all groups, empty bins included, last bin closed.

    Missing and infinite values are left out. A constant column gets the range value +- 0.5.
    """
    x = finite(df, value).cast("double")
    data = df.select(*([by] if by else []), x.alias("__x")).filter(F.col("__x").isNotNull())
    lo, hi = limits or data.agg(F.min("__x"), F.max("__x")).first()
    if lo is None:
        lo = hi = 0.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    at = F.least(F.floor((F.col("__x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    group = [by] if by else []
    counts = data.groupBy(*group, at.alias("bin")).agg(F.count("*").alias("n"))
    filled = counts.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    return filled.select(*group, "found", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        *group, "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("n"),
    )


def invalid_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing and infinite values over all columns, with the verdict."""
    missing, infinite = F.lit(0), F.lit(0)
    for c in cols:
        x = present(df, c).cast("double")
        missing = missing + x.isNull().cast("int")
        infinite = infinite + F.coalesce(F.abs(x) == float("inf"), F.lit(False)).cast("int")
    counts = df.agg(F.coalesce(F.sum(missing), F.lit(0)).alias("n_missing"),
                    F.coalesce(F.sum(infinite), F.lit(0)).alias("n_infinite"))
    return counts.withColumn("is_valid", (F.col("n_missing") == 0) & (F.col("n_infinite") == 0))


def column_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and sample deviation of the finite values per column."""
    data = df.select(*[finite(df, c).cast("double").alias(c) for c in cols])
    return long_aggregate(data, cols, {
        "min_value": F.min, "max_value": F.max, "mean_value": F.avg, "std_value": F.stddev_samp,
    })


def value_counts(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Rows per value of each column, in one shuffle; values as text."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return (df.select(F.inline(cells)).filter(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count("*").alias("n")))


def unparsable_report(df: DataFrame, cols: Sequence[str], samples: int = 3) -> DataFrame:
    """Per text column: values that are no number, with the first few distinct ones.

    The window keeps the few smallest values per column, which Spark limits before the shuffle.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                               F.expr(f"try_cast(`{c}` AS double)").alias("number")) for c in cols])
    bad = (df.select(F.inline(cells)).filter(F.col("value").isNotNull() & F.col("number").isNull())
           .groupBy("column_name", "value").agg(F.count("*").alias("n")))
    first = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    shown = (bad.withColumn("rank", first).filter(F.col("rank") <= samples)
             .groupBy("column_name")
             .agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("sample_values")))
    counts = bad.groupBy("column_name").agg(F.sum("n").alias("n_unparsable"),
                                            F.count("*").alias("n_distinct"))
    return counts.join(shown, "column_name")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def running_totals(
    pred: DataFrame, ts: str, prediction: str = "prediction", rows_per_slice: int | None = None
) -> DataFrame:
    """Flows and attacks so far, and the attack rate, at each distinct time.

    Rows of one instant are counted first, so a burst cannot pile up in one window.
    """
    cuts = fit_cuts(pred, ts, rows_per_slice)
    at = pred.groupBy(ts).agg(F.count("*").alias("__n"),
                              F.count_if(F.col(prediction) == 1).alias("__a"))
    total = running_sums(at, [ts], {"total_flows": F.col("__n"), "total_attacks": F.col("__a")}, cuts=cuts)
    rate = F.col("total_attacks") * 100.0 / F.col("total_flows")
    return total.select(ts, "total_flows", "total_attacks", rate.alias("attack_rate_pct"))


def interarrival_stats(df: DataFrame, ts: str, by: str | None = None) -> DataFrame:
    """Time range, duration and mean gap in seconds; (last - first) / (n - 1) needs no ordering."""
    micros = order_value(df, ts)
    span = (F.max(micros) - F.min(micros)) / F.lit(1e6)
    n = F.count(micros)
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(
        n.alias("n_flows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        span.alias("duration_s"), F.when(n > 1, span / (n - 1)).alias("mean_gap_s"))


def recent_stats(
    pred: DataFrame, ts: str, key: str, n: int = 100,
    prediction: str = "prediction", confidence: str = "confidence",
) -> DataFrame:
    """Flows, attacks and mean confidence over the last ``n`` predictions."""
    last = pred.orderBy(F.col(ts).desc(), F.col(key).desc()).limit(n)
    return last.agg(F.count("*").alias("n_recent"),
                    F.count_if(F.col(prediction) == 1).alias("n_attacks"),
                    F.avg(confidence).alias("avg_confidence"))
