"""Sampling and splitting: by hash, by time, stratified."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions import hash_hex
from flowlab.operators.features import class_counts, parsed_time

# Default borders of the time split (train ends, validation ends; both exclusive).
TRAIN_END = "2018-02-20"
VAL_END = "2018-02-22"

SEED = 42
TEST_FRACTION = 0.2
_PREFIX = 4


def sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Bernoulli sample; which rows it takes depends on the partitioning."""
    return df.sample(fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = SEED) -> DataFrame:
    """Bernoulli sample by key hash: the same rows in any partitioning."""
    if fraction >= 1:
        return df
    border = f"{int(fraction * 16**8):08x}"
    return df.filter(F.substring(hash_hex(key, seed=seed), 1, 8) < border)


def _border(df: DataFrame, ts: str, value: str) -> Column:
    """A time literal of the column's own type, so that comparisons reach the scan."""
    kind = df.schema[ts].dataType.simpleString()
    return F.lit(value).cast("timestamp" if kind == "string" else kind)


def time_slice(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with start <= ts < end; on a parsed column the filter reaches the scan."""
    when = parsed_time(df, ts)
    return df.filter((when >= _border(df, ts, start)) & (when < _border(df, ts, end)))


def with_time_split(
    df: DataFrame,
    ts: str = "Timestamp",
    train_end: str = TRAIN_END,
    val_end: str = VAL_END,
    out: str = "split",
    formats: Sequence[str] = (),
) -> DataFrame:
    """Column train / val / test by half-open time ranges; rows without a valid time are dropped."""
    when = parsed_time(df, ts, formats)
    part = (F.when(when < _border(df, ts, train_end), "train")
            .when(when < _border(df, ts, val_end), "val")
            .otherwise("test"))
    return df.filter(when.isNotNull()).withColumn(out, part)


def split_by_time(
    df: DataFrame,
    ts: str = "Timestamp",
    train_end: str = TRAIN_END,
    val_end: str = VAL_END,
    formats: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames, each a plain time range on the source."""
    when = parsed_time(df, ts, formats)
    first, second = _border(df, ts, train_end), _border(df, ts, val_end)
    return df.filter(when < first), df.filter((when >= first) & (when < second)), df.filter(when >= second)


def quotas(counts: Mapping, test: float = TEST_FRACTION) -> dict:
    """Test rows per class by largest remainder, summing to ceil(test * n)."""
    share = Fraction(str(test))
    exact = {c: n * share for c, n in counts.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    left = math.ceil(sum(counts.values()) * share) - sum(quota.values())
    by_rest = sorted(exact, key=lambda c: (quota[c] - exact[c], str(c)))
    for c in by_rest[:left]:
        quota[c] += 1
    return quota


@dataclass(frozen=True)
class StratifiedSplit:
    """Per class, the largest (hash, key) that still goes to test."""

    key: str
    label: str
    seed: int
    borders: Mapping

    def is_test(self) -> Column:
        """Row-local test, so applying the split needs no shuffle."""
        here = F.struct(hash_hex(self.key, seed=self.seed).alias("h"), F.col(self.key).alias("k"))
        hit = F.lit(False)
        for value, border in self.borders.items():
            if border is not None:
                limit = F.struct(F.lit(border[0]).alias("h"), F.lit(border[1]).alias("k"))
                hit = hit | (F.col(self.label).eqNullSafe(F.lit(value)) & (here <= limit))
        return hit

    def mark(self, df: DataFrame, out: str = "split") -> DataFrame:
        return df.withColumn(out, F.when(self.is_test(), "test").otherwise("train"))


def fit_borders(df: DataFrame, key: str, label: str, quota: Mapping, seed: int = SEED) -> StratifiedSplit:
    """Borders that give each class its quota of rows, lowest hashes first.

    No class is ranked in one task: counts per hash prefix (at most 65,536 per class) locate the
    prefix the quota falls into, and only the rows of that prefix are ranked. ``key`` must be unique.
    """
    rows = df.select(F.col(key).alias("k"), F.col(label).alias("y"), hash_hex(key, seed=seed).alias("h"))
    need = F.lit(0)
    for value, n in quota.items():
        need = F.when(F.col("y").eqNullSafe(F.lit(value)), n).otherwise(need)
    prefix = F.substring("h", 1, _PREFIX).alias("prefix")
    upto = Window.partitionBy("y").orderBy("prefix")
    hist = rows.groupBy("y", prefix).agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto))
    at = {r["y"]: (r["prefix"], r["need"] - r["upto"] + r["n"]) for r in
          hist.withColumn("need", need)
          .filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
          .collect()}
    inside, wanted = F.lit(False), F.lit(0)
    for value, (start, rest) in at.items():
        mine = F.col("y").eqNullSafe(F.lit(value))
        inside = inside | (mine & F.col("h").startswith(start))
        wanted = F.when(mine, rest).otherwise(wanted)
    rank = F.row_number().over(Window.partitionBy("y").orderBy("h", "k"))
    found = (rows.filter(inside).withColumn("rank", rank)
             .filter(F.col("rank") == wanted).select("y", "h", "k").collect())
    borders = {value: None for value in quota} | {r["y"]: (r["h"], r["k"]) for r in found}
    return StratifiedSplit(key, label, seed, borders)


def fit_stratified_split(
    df: DataFrame, key: str, label: str, test: float = TEST_FRACTION, seed: int = SEED
) -> StratifiedSplit:
    """Split with equal class shares in both parts."""
    return fit_borders(df, key, label, quotas(class_counts(df, label), test), seed)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = TEST_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test with equal class shares."""
    split = fit_stratified_split(df, key, label, test, seed)
    return df.filter(~split.is_test()), df.filter(split.is_test())
