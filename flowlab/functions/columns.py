"""Column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.DoubleType, T.FloatType)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den where den is positive, else 0."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def coef_variation(std: str | Column, mean: str | Column) -> Column:
    """Standard deviation over mean where the mean is positive, else 0."""
    return safe_ratio(std, mean)


def bytes_per_packet(fwd_bytes, bwd_bytes, fwd_pkts, bwd_pkts) -> Column:
    """Bytes of both directions over packets of both directions."""
    return safe_ratio(_col(fwd_bytes) + _col(bwd_bytes), _col(fwd_pkts) + _col(bwd_pkts))


def packet_rate(fwd_pkts, bwd_pkts, duration, unit: float = 1e6) -> Column:
    """Packets per second; ``unit`` is the number of duration ticks in one second."""
    return safe_ratio(_col(fwd_pkts) + _col(bwd_pkts), duration) * F.lit(float(unit))


def any_positive(*cols: str | Column) -> Column:
    """1 if any of the columns is above zero, else 0 (null counts as not above)."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(_col(c) > 0, F.lit(False))
    return hit.cast("int")


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN in floating columns."""
    test = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, FLOATING):
        test = test | F.isnan(name)
    return test


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


def finite(df: DataFrame, name: str) -> Column:
    """The column with NaN and both infinities turned into null."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(F.abs(name) < F.lit(float("inf")), F.col(name))
    return F.col(name)


def hash_hex(*cols: str | Column, seed: int | str = 42) -> Column:
    """md5 hex of the columns and the seed: the same in any partitioning and any engine."""
    return F.md5(F.concat_ws(":", *[_col(c).cast("string") for c in cols], F.lit(str(seed))))


def hash_uniform(*parts: str | Column) -> Column:
    """A double in [0, 1) from a hash of the parts: the same in any partitioning."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))
