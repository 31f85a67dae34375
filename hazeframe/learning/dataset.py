"""Supervised data set from hourly readings, and its split in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.operators.timeseries import (
    REACH,
    calendar_features,
    hourly_grid,
    lag_features,
    lagged,
    own_rows,
    rolling_features,
    series_keys,
)

EXTRA_PREDICTORS = ("no2_raw", "temp_internal", "humidity_internal")
IDENTIFIERS = ("timestamp", "device_id", "city")
TRAIN_FRACTION = 0.8


def build_dataset(
    measurements: DataFrame, sensors: DataFrame, target_column: str = "pm25_raw", horizon: int = 1
) -> DataFrame:
    """Features known at each hour and `target`, the value `horizon` hours later.

    Lags, rolling statistics and lead share one partitioning and one sort by device and month, with months that overlap
    by what they reach; no task holds more than a month of a device. Unlike a rolling window over the stacked series,
    frames never reach into another device.
    """
    others = [c for c in EXTRA_PREDICTORS if c != target_column]
    grid = hourly_grid(measurements, sensors, [target_column, *others], margin=(REACH, max(horizon, 0)))
    featured = rolling_features(lag_features(grid, target_column), target_column)
    featured = own_rows(featured.withColumn("target", lagged(target_column, -horizon, series_keys(grid))))
    complete = calendar_features(featured).na.drop(subset=[target_column, "target", "lag_1h"])
    features = [c for c in complete.columns if c not in (*IDENTIFIERS, "target")]
    return complete.select(*IDENTIFIERS, *features, "target")


def feature_columns(dataset: DataFrame) -> list[str]:
    return [c for c in dataset.columns if c not in (*IDENTIFIERS, "target")]


def missing_feature_share(dataset: DataFrame, features: Sequence[str]) -> DataFrame:
    """Average over features of their percentage of missing values."""
    shares = [F.avg(F.col(c).isNull().cast("double")) for c in features]
    total = shares[0]
    for share in shares[1:]:
        total = total + share
    return dataset.agg((total * 100.0 / len(shares)).alias("missing_pct"))


def dataset_overview(dataset: DataFrame) -> DataFrame:
    """Rows, devices and period of a data set."""
    return dataset.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("device_id").alias("n_devices"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


def split_point(dataset: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """One row: the interpolated quantile of the timestamps.

    Timestamps lie on the hourly grid, so the exact percentile keeps one counter per hour of the period.
    """
    micros = F.percentile(F.unix_micros("timestamp"), fraction)
    return dataset.agg(F.timestamp_micros(micros.cast("bigint")).alias("split_ts"))


def time_split(
    dataset: DataFrame, fraction: float = TRAIN_FRACTION, split_ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test): up to and after the split point."""
    split_ts = split_point(dataset, fraction).scalar() if split_ts is None else split_ts
    return dataset.where(F.col("timestamp") <= split_ts), dataset.where(F.col("timestamp") > split_ts)


def evaluate(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 (1 - residual / total sum of squares), NULL R2 for a constant truth."""
    error = F.col(actual) - F.col(predicted)
    scored = F.when(error.isNotNull(), F.col(actual))
    spread = F.var_pop(scored) * F.count(error)
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )
