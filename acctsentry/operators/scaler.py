"""Standard scaler (A15, M1): mean and population std per feature."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry import schema as S
from acctsentry.operators.artifacts import if_there

EPS = float(np.finfo(np.float64).eps)


def fit_scaler(matrix: DataFrame, features: list[str] = S.MODEL_FEATURES) -> DataFrame:
    """One aggregate pass; returns (position, feature, mean, scale).

    A feature whose variance is within rounding of zero gets scale 1, as the
    usual standard-scaler convention does (relative test on n, mean, var).
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(features):
        aggs += [F.avg(f).alias(f"_m{i}"), F.var_pop(f).alias(f"_v{i}")]
    wide = matrix.agg(*aggs)
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"),
                 F.col(f"_m{i}").alias("mean"), F.col(f"_v{i}").alias("var"))
        for i, f in enumerate(features)
    ]
    long = wide.select("_n", F.explode(F.array(*entries)).alias("e")).select("_n", "e.*")
    n, var, mean = F.col("_n"), F.col("var"), F.col("mean")
    constant = var <= n * F.lit(EPS) * var + F.pow(n * mean * F.lit(EPS), 2)
    return long.select(
        "position", "feature", "mean",
        F.when(constant, F.lit(1.0)).otherwise(F.sqrt(var)).alias("scale"),
    )


def scaler_params(scaler: DataFrame) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Collect the (bounded: one row per feature) scaler to the driver."""
    rows = sorted(scaler.collect(), key=lambda r: r["position"])
    return (
        np.array([r["mean"] for r in rows], dtype=float),
        np.array([r["scale"] for r in rows], dtype=float),
        [r["feature"] for r in rows],
    )


def apply_scaler(matrix: DataFrame, scaler: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M1: (x - mean) / scale per feature, as column expressions with the
    scaler values as literals."""
    mean, scale, feats = scaler_params(scaler)
    keep = keep if keep is not None else [c for c in matrix.columns if c not in feats]
    return matrix.select(
        *keep,
        *[((F.col(f) - F.lit(float(m))) / F.lit(float(s))).alias(f) for f, m, s in zip(feats, mean, scale)],
    )


def save_scaler(scaler: DataFrame, path: str) -> None:
    """One row per feature (position, feature, mean, scale)."""
    scaler.coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame | None:
    """S7 read; a missing artifact gives None."""
    return if_there(lambda: spark.read.parquet(path))
