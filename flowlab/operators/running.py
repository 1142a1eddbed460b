"""Ordered computations (running totals, previous value) that survive hot keys.

A window over one key, or over no key at all, is a single task. Here rows are cut into ordered
slices of bounded size by fitted cut points, each (key, slice) is its own window, and what one
slice needs from the earlier ones travels in a small carry table with one row per (key, slice).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.session import size

MAX_SLICES = 4096
ACCURACY = 20_000

_SLICE = "__slice"
_ORDER = "__order"
_KEY = "__key"


def order_value(df: DataFrame, name: str) -> Column:
    """A double that sorts like the column; timestamps become epoch microseconds, dates epoch days."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("double")
    return F.col(name).cast("double")


def fit_cuts(
    df: DataFrame, name: str, rows_per_slice: int | None = None, max_slices: int = MAX_SLICES
) -> list[float]:
    """Ascending cut points so that a slice holds about ``rows_per_slice`` rows.

    One count, and a sketch of the column only where more than one slice is needed.
    """
    rows_per_slice = rows_per_slice or size(df.sparkSession, "spark.flowlab.rowsPerSlice")
    data = df.select(order_value(df, name).alias(_ORDER))
    n = data.agg(F.count(_ORDER)).first()[0]
    slices = min(max_slices, math.ceil(n / rows_per_slice))
    if slices < 2:
        return []
    marks = ", ".join(f"{i / slices!r}D" for i in range(1, slices))
    points = data.agg(F.expr(f"percentile_approx({_ORDER}, array({marks}), {ACCURACY})")).first()[0]
    return sorted({p for p in points if math.isfinite(p)})


def with_slice(df: DataFrame, name: str, cuts: Sequence[float], out: str = _SLICE) -> DataFrame:
    """Number of cut points at or below the value, by binary search in the JVM; -1 for a null."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol=_ORDER, outputCol=out, handleInvalid="keep")
    cut = bucketizer.transform(df.withColumn(_ORDER, order_value(df, name)))
    last = F.lit(len(splits) - 1)
    # Nulls sort below every value, so they are a slice below the first.
    place = F.when(F.col(_ORDER).isNull(), F.lit(-1)).otherwise(F.coalesce(F.col(out).cast("int"), last))
    return cut.withColumn(out, place).drop(_ORDER)


def _keyed(df: DataFrame, order: str, cuts: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Slice plus one struct key, which is never null, so rows with a null key join as well."""
    sliced = with_slice(df, order, cuts)
    return sliced.withColumn(_KEY, F.struct(*by)) if by else sliced


def _attach(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join on the window's own partitioning, so the row side is not shuffled again."""
    return rows.join(carry, [F.col(k) == F.col(f"__k{k}") for k in keys])


def running_sums(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] = (),
    totals: Mapping[str, Column] | None = None,
    largest_before: Mapping[str, Column] | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add running values in the given order, all in one shuffle of the rows.

    ``sums`` are cumulative sums, rows equal in ``order`` included; ``largest_before`` is the
    largest value in the rows strictly before, with ``tie`` settling the order of equal rows;
    ``totals`` are sums over the whole key. ``cuts`` are cut points of ``order[0]``; without any,
    all rows of a key are one slice, which ``fit_cuts`` allows only up to ``rows_per_slice`` rows in
    the whole table. The carry table has one row per (key, slice), so without a key it holds at
    most MAX_SLICES + 1 rows and is broadcast.
    """
    totals, largest = dict(totals or {}), dict(largest_before or {})
    sliced = _keyed(df, order[0], cuts, by)
    group = [_KEY] if by else []
    keys = [*group, _SLICE]

    def direct(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    whole = Window.partitionBy(*group or [F.lit(0)])
    in_slice = Window.partitionBy(*keys)
    upto = in_slice.orderBy(*[direct(c) for c in order])
    above = in_slice.orderBy(*[direct(c) for c in [*order, *tie]]).rowsBetween(Window.unboundedPreceding, -1)
    if not cuts:
        return sliced.select(*df.columns, *[F.sum(c).over(upto).alias(n) for n, c in sums.items()],
                             *[F.max(c).over(above).alias(n) for n, c in largest.items()],
                             *[F.sum(c).over(in_slice).alias(n) for n, c in totals.items()])
    before = whole.orderBy(direct(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    parts = sliced.groupBy(*keys).agg(
        *[F.sum(c).alias(f"__s_{name}") for name, c in sums.items()],
        *[F.max(c).alias(f"__m_{name}") for name, c in largest.items()],
        *[F.sum(c).alias(f"__t_{name}") for name, c in totals.items()],
    )
    carry = parts.select(
        *[F.col(k).alias(f"__k{k}") for k in keys],
        *[F.coalesce(F.sum(f"__s_{name}").over(before), F.lit(0)).alias(f"__c_{name}") for name in sums],
        *[F.max(f"__m_{name}").over(before).alias(f"__c_{name}") for name in largest],
        *[F.sum(f"__t_{name}").over(whole).alias(name) for name in totals],
    )
    running = sliced.withColumns({
        **{f"__r_{name}": F.sum(c).over(upto) for name, c in sums.items()},
        **{f"__r_{name}": F.max(c).over(above) for name, c in largest.items()}})
    return _attach(running, carry if by else F.broadcast(carry), keys).select(
        *df.columns,
        *[(F.col(f"__r_{name}") + F.col(f"__c_{name}")).alias(name) for name in sums],
        *[F.greatest(f"__r_{name}", f"__c_{name}").alias(name) for name in largest],
        *totals,
    )


def previous_value(
    df: DataFrame,
    ts: str,
    key: str,
    by: Sequence[str],
    out: str,
    cuts: Sequence[float] = (),
) -> DataFrame:
    """Add the ``ts`` of the row before in (ts, key) order within ``by``."""
    return running_sums(df, [ts], {}, by, cuts=cuts, largest_before={out: F.col(ts)}, tie=[key])
