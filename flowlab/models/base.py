"""A fitted model with everything scoring needs: features, scaling, Spark ML stages, metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.operators.cleaning import align_features
from flowlab.operators.scoring import HIGH_CONFIDENCE, THRESHOLD, enrich
from flowlab.operators.vectors import Scaler, feature_array

VECTOR = "__features"
# Columns that are no features in a labeled flow table.
NOT_FEATURES = ("Label", "label", "attack_type", "is_attack")

def with_vector(df: DataFrame, features: Sequence[str], scaler: Scaler | None = None) -> DataFrame:
    return df.withColumn(VECTOR, array_to_vector(feature_array(df, features, scaler)))


@dataclass
class FlowModel:
    """Fitted classifier. ``probability`` names the stage outputs whose mean is the score."""

    stages: PipelineModel
    features: list[str]
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    probability: list[str] = field(default_factory=lambda: ["probability"])
    meta: dict = field(default_factory=dict)

    def score(self, df: DataFrame, out: str = "attack_probability") -> DataFrame:
        """Input columns plus the attack probability; one pass through the stages."""
        scored = self.stages.transform(with_vector(df, self.features, self.scaler))
        shares = [vector_to_array(F.col(c))[1] for c in self.probability]
        mean = sum(shares[1:], shares[0]) / F.lit(float(len(shares)))
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], mean.alias(out))


@dataclass
class ArrayModel(FlowModel):
    """A model that is a few arrays in the place of Spark ML stages; subclasses say how rows are scored by them."""

    packed: dict[str, np.ndarray] = field(default_factory=dict)
    stored_as = ""

    @staticmethod
    def probabilities(packed: Mapping[str, np.ndarray], x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def score(self, df: DataFrame, out: str = "attack_probability") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.packed)
        width, probabilities = len(self.features), self.probabilities

        @F.arrow_udf("double")
        def scored(x: pa.Array) -> pa.Array:
            return pa.array(probabilities(shared.value, x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)))

        return df.select(*[F.col(f"`{c}`") for c in df.columns], scored(feature_array(df, self.features, self.scaler)).alias(out))


def predict(
    df: DataFrame, model: FlowModel, threshold: float = THRESHOLD, high: float = HIGH_CONFIDENCE,
    only_features: bool = False, keep: Sequence[str] = (),
) -> DataFrame:
    """Score and enrich. Absent features count as 0, extra columns pass through untouched."""
    rows = align_features(df, model.features, keep) if only_features else df
    return enrich(model.score(rows), threshold=threshold, high=high)
