"""Delimited-table preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.operators.counts import duplicate_summary


def labeled_points(df: DataFrame, label: str | None = None,
                   features: Sequence[str] | None = None) -> DataFrame:
    """P10: last column is the label, the others (``dropRight(1)``) the
    features, all cast to double → (label double, features array<double>).
    Pass the result through ``VectorAssembler``-free code, or call
    ``to_ml_vectors`` when an MLlib estimator needs a vector column."""
    cols = df.columns
    label = label or cols[-1]
    features = list(features or [c for c in cols if c != label])
    return df.select(F.col(label).cast("double").alias("label"),
                     F.array(*[F.col(c).cast("double") for c in features]).alias("features"))


def to_ml_vectors(points: DataFrame) -> DataFrame:
    """(label, features array<double>) → (label, features vector)."""
    from pyspark.ml.functions import array_to_vector
    return points.select("label", array_to_vector("features").alias("features"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """``count - distinct count`` over whole rows, one pass."""
    return duplicate_summary(df)
