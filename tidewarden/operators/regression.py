"""Ordinary least squares per key: statistics in Spark, one small solve per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Eigenvalues of the covariance below this share of the largest one count as zero, so that
# constant or collinear regressors get the minimum-norm solution.
RANK_CUTOFF = 1e-12


def complete_cases(features: DataFrame) -> DataFrame:
    return features.na.drop("any")


def regression_stats(features: DataFrame, key: str, inputs: Sequence[str],
                     targets: Sequence[str], min_rows: int = 5) -> DataFrame:
    """Per key with at least ``min_rows`` complete rows: count, means and covariances.

    All are hash aggregates with a map-side partial step, so a hot key needs no special care.
    """
    aggregates = [F.count(F.lit(1)).alias("n")]
    aggregates += [F.avg(c).alias(f"mean_{c}") for c in (*inputs, *targets)]
    aggregates += [F.covar_pop(a, b).alias(f"cov_{a}_{b}")
                   for i, a in enumerate(inputs) for b in (*inputs[i:], *targets)]
    return (complete_cases(features.select(key, *inputs, *targets))
            .groupBy(key).agg(*aggregates).filter(F.col("n") >= min_rows))


def solved(stats: DataFrame, key: str, inputs: Sequence[str],
           targets: dict[str, int]) -> DataFrame:
    """Coefficient rows ``key, horizon, intercept, b0.., n``, one per key and target.

    ``targets`` maps a target column to its horizon. The solver sees one row per key, a batch of
    them at a time; minimum-norm where the regressors are rank-deficient.
    """
    inputs = list(inputs)
    slopes = [f"b{i}" for i in range(len(inputs))]
    schema = T.StructType([
        stats.schema[key],
        T.StructField("horizon", T.IntegerType()), T.StructField("intercept", T.DoubleType()),
        *[T.StructField(b, T.DoubleType()) for b in slopes],
        T.StructField("n", T.LongType())])
    cutoff = RANK_CUTOFF

    def solve(batches: Iterator):
        import numpy as np
        import pandas as pd

        for batch in batches:
            size = len(inputs)
            covariance = np.empty((len(batch), size, size))
            for i, a in enumerate(inputs):
                for j, b in enumerate(inputs[i:], start=i):
                    covariance[:, i, j] = covariance[:, j, i] = batch[f"cov_{a}_{b}"]
            inverse = np.linalg.pinv(covariance, rcond=cutoff, hermitian=True)
            means = batch[[f"mean_{c}" for c in inputs]].to_numpy()
            for target, horizon in targets.items():
                joint = batch[[f"cov_{c}_{target}" for c in inputs]].to_numpy()
                beta = np.einsum("kij,kj->ki", inverse, joint)
                level = batch[f"mean_{target}"].to_numpy() - (beta * means).sum(axis=1)
                yield pd.DataFrame({
                    key: batch[key], "horizon": np.int32(horizon), "intercept": level,
                    **{b: beta[:, i] for i, b in enumerate(slopes)}, "n": batch["n"]})

    return stats.mapInPandas(solve, schema)


def predicted(inputs: Sequence[str]) -> Column:
    """Linear prediction from coefficient columns, not below zero, null if an input is null."""
    value = F.col("intercept")
    for i, name in enumerate(inputs):
        value = value + F.col(f"b{i}") * F.col(name)
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))
