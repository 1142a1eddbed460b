"""Feature columns as one array."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.functions import finite

Scaler = Mapping[str, tuple[float, float]]


def feature_array(df: DataFrame, features: Sequence[str], scaler: Scaler | None = None) -> Column:
    """Array of doubles: absent, missing and infinite values count as 0, then scaling applies."""
    cells = []
    for c in features:
        x = F.coalesce(finite(df, c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
        if scaler and c in scaler:
            mean, std = scaler[c]
            x = (x - F.lit(mean)) / F.lit(std)
        cells.append(x)
    return F.array(*cells)
