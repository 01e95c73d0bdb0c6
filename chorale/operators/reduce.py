"""Principal components of an array<double> column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.operators.cluster import as_ml


@dataclass(frozen=True)
class Components:
    """Centre, directions (one row per component) and variance shares."""

    mean: np.ndarray
    directions: np.ndarray
    variance_ratio: np.ndarray


def fit_pca(df: DataFrame, vector: str, n: int = 2) -> Components:
    """Leading principal directions; the largest loading of each is positive."""
    width = df.select(F.size(vector)).first()[0]
    model = PCA(k=n, inputCol="features", outputCol="pc").fit(as_ml(df.select(vector), vector))
    x = F.col(vector)
    mean = df.agg(F.array(*[F.avg(x[i].cast("double")) for i in range(width)])).first()[0]
    directions = model.pc.toArray().T
    largest = np.abs(directions).argmax(axis=1)
    signs = np.sign(directions[np.arange(len(directions)), largest])
    return Components(np.array(mean), directions * signs[:, None], model.explainedVariance.toArray())


def _numbers(values) -> Column:
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def project(model: Components, df: DataFrame, vector: str, out: str = "pc") -> DataFrame:
    """Add the centred scores as array<double>: a projection, no shuffle."""
    centred = F.zip_with(F.col(vector).cast("array<double>"), _numbers(model.mean), lambda x, m: x - m)
    scores = F.array(*[_dot(F.col("_centred"), _numbers(row)) for row in model.directions])
    return df.withColumn("_centred", centred).withColumn(out, scores).drop("_centred")


def components_for(ratios: Sequence[float], share: float = 0.95) -> int:
    """Components needed for a share of the variance; one more than there are
    when it is not reached."""
    return int(np.searchsorted(np.cumsum(ratios), share)) + 1


def pca_scores(model: Components, df: DataFrame, vector: str) -> DataFrame:
    """One row: variance shares, components for 95 %, reconstruction error.

    What the kept directions do not explain of a row is its centred length
    minus the length of its scores.
    """
    width = len(model.mean)
    scored = project(model, df.select(vector), vector, "_pc")
    centred = F.zip_with(F.col(vector).cast("array<double>"), _numbers(model.mean), lambda x, m: x - m)
    left = scored.withColumn("_c", centred).agg(
        F.avg((_dot(F.col("_c"), F.col("_c")) - _dot(F.col("_pc"), F.col("_pc"))) / width).alias("mse")
    )
    ratios = [float(r) for r in model.variance_ratio]
    return left.select(
        _numbers(ratios).alias("explained_variance_ratio"),
        _numbers(np.cumsum(ratios)).alias("cumulative_explained_variance"),
        F.lit(components_for(ratios)).alias("components_for_95pct_variance"),
        F.greatest("mse", F.lit(0.0)).alias("reconstruction_mse"),
        F.lit(len(ratios)).alias("n_components_used"),
        F.lit(width).alias("n_features_original"),
    )


def loadings(spark, model: Components, names: Sequence[str]) -> DataFrame:
    """(component, feature, loading)."""
    rows = [
        (i + 1, name, float(v)) for i, line in enumerate(model.directions) for name, v in zip(names, line)
    ]
    return spark.createDataFrame(rows, "component int, feature string, loading double")
