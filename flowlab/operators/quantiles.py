"""Exact quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a column in one buffer, which does not hold at
scale. Here each wanted rank is narrowed by sketches until few enough rows are left between two
data values, and only those are gathered. Counts, not the sketch's error bound, decide every
step, so the result is exact. Two scans suffice for small tables, three to five for 10^12 rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.functions import finite, present
from flowlab.session import size

ACCURACY = 10_000
RANKS_PER_JOB = 40
COLUMNS_PER_JOB = 100


@dataclass
class _Search:
    """One order statistic: the ``rank``-th value (from 0) lies strictly between low and high."""

    column: str
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def window(self) -> Column:
        x = F.col(self.column)
        if self.low is not None:
            x = F.when(x > F.lit(self.low), x)
        if self.high is not None:
            x = F.when(x < F.lit(self.high), x)
        return x


def _chunks(items: Sequence, size: int) -> Iterable[Sequence]:
    for start in range(0, len(items), size):
        yield items[start:start + size]


def _sketch(data: DataFrame, searches: list[_Search]) -> list[tuple[float, float]]:
    """Two sketched values of the open interval that should enclose the rank."""
    cells = []
    for s in searches:
        at = (s.rank - s.below) / s.inside
        marks = [max(0.0, at - 2 / ACCURACY), min(1.0, at + 2 / ACCURACY)]
        cells.append(F.percentile_approx(s.window(), marks, ACCURACY))
    return [tuple(pair) for pair in data.agg(*cells).first()]


def _narrow(data: DataFrame, searches: list[_Search], guesses: list[tuple[float, float]]) -> None:
    """Shrink each open interval to what exact counts around the two guessed values allow."""
    cells = []
    for s, (lo, hi) in zip(searches, guesses, strict=True):
        x = F.col(s.column)
        cells += [F.count_if(x < lo), F.count_if(x <= lo), F.count_if(x < hi), F.count_if(x <= hi)]
    counts = data.agg(*cells).first()
    for i, (s, (lo, hi)) in enumerate(zip(searches, guesses, strict=True)):
        lt_lo, le_lo, lt_hi, le_hi = counts[4 * i:4 * i + 4]
        end = s.below + s.inside
        if lt_lo <= s.rank < le_lo:
            s.value = lo
        elif lt_hi <= s.rank < le_hi:
            s.value = hi
        elif s.rank < lt_lo:
            s.high, s.inside = lo, lt_lo - s.below
        elif s.rank >= le_hi:
            s.low, s.below, s.inside = hi, le_hi, end - le_hi
        else:
            s.low, s.high, s.below, s.inside = lo, hi, le_lo, lt_hi - le_lo


def _gather(data: DataFrame, searches: list[_Search]) -> None:
    """Pick the ranks out of intervals known to hold at most the gathered size."""
    for part in _chunks(searches, RANKS_PER_JOB):
        picks = [F.sort_array(F.collect_list(s.window()))[s.rank - s.below] for s in part]
        for s, value in zip(part, data.agg(*picks).first(), strict=True):
            s.value = value


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    finite_only: bool = False,
    gather_rows: int | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; null and NaN are left out.

    A column without any value yields None for each quantile.
    """
    if not wanted:
        return {}
    gather_rows = gather_rows or size(df.sparkSession, "spark.flowlab.gatherRows")
    clean = finite if finite_only else present
    data = df.select(*[clean(df, c).cast("double").alias(c) for c in wanted])
    sizes: dict[str, int] = {}
    guesses: dict[tuple[str, int], tuple[float, float]] = {}
    searches: dict[tuple[str, int], _Search] = {}
    for part in _chunks(list(wanted), COLUMNS_PER_JOB):
        marks = {c: [m for q in wanted[c] for m in (max(0.0, q - 2 / ACCURACY), min(1.0, q + 2 / ACCURACY))]
                 for c in part}
        row = data.agg(*[f for c in part for f in (F.count(c), F.percentile_approx(c, marks[c], ACCURACY))]).first()
        for i, c in enumerate(part):
            sizes[c], sketch = row[2 * i], row[2 * i + 1]
            for j, q in enumerate(wanted[c] if sizes[c] else []):
                at = q * (sizes[c] - 1)
                for rank in {math.floor(at), math.ceil(at)}:
                    searches[c, rank] = _Search(c, rank, 0, sizes[c])
                    guesses[c, rank] = (sketch[2 * j], sketch[2 * j + 1])
    large = [k for k, s in searches.items() if s.inside > gather_rows]
    for part in _chunks(large, RANKS_PER_JOB):
        _narrow(data, [searches[k] for k in part], [guesses[k] for k in part])
    while todo := [s for s in searches.values() if s.value is None]:
        _gather(data, [s for s in todo if s.inside <= gather_rows])
        for part in _chunks([s for s in todo if s.value is None], RANKS_PER_JOB):
            _narrow(data, part, _sketch(data, part))

    def at_point(c: str, q: float) -> float | None:
        if not sizes[c]:
            return None
        at = q * (sizes[c] - 1)
        low, high = searches[c, math.floor(at)].value, searches[c, math.ceil(at)].value
        return low if low == high else low + (high - low) * (at - math.floor(at))

    return {c: [at_point(c, q) for q in points] for c, points in wanted.items()}


def approx_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], error: float = 0.01
) -> dict[str, list[float | None]]:
    """Sketch-based quantiles in one scan; each is an element of the column."""
    aggs = [F.percentile_approx(present(df, c).cast("double"), list(qs), int(1 / error)).alias(c)
            for c, qs in wanted.items()]
    row = df.agg(*aggs).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(wanted[c]) for c in wanted}
