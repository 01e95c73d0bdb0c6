"""Standardisation with the population deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """Mean and deviation per column: a few numbers, held on the driver."""

    mean: dict[str, float]
    scale: dict[str, float]

    def scaled(self, c: str) -> Column:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        return (value - F.lit(self.mean[c])) / F.lit(self.scale[c])

    def transform(self, df: DataFrame, suffix: str = "_z") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": self.scaled(c) for c in self.mean})


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """One aggregation; nulls count as zero, a constant column keeps scale 1."""
    present = [c for c in cols if c in df.columns]
    if not present:
        raise ValueError(f"none of {list(cols)} are columns")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in present}
    row = df.agg(
        *[F.avg(v).alias(f"{c}__m") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"{c}__s") for c, v in filled.items()],
    ).first()
    return Scaler(
        {c: row[f"{c}__m"] or 0.0 for c in present},
        {c: row[f"{c}__s"] or 1.0 for c in present},
    )


def fit_transform(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    return fit_scaler(df, cols).transform(df, suffix)
