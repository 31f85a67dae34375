"""Queries behind the interactive views: filters, map, series and lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.functions import air_index, clock
from hazeframe.functions.numeric import half_even, ratio, to_number
from hazeframe.operators.anomalies import worst_days
from hazeframe.sources.tables import MONTH

MIN_RADIUS = 6.0
RADIUS_RANGE = 14.0


def filter_period(df: DataFrame, start: dt.date, end: dt.date, time: str = "timestamp") -> DataFrame:
    """Rows whose local date lies in [start, end].

    The two local days are also given as UTC instants, which Parquet can compare with its row-group
    statistics, and as months where the table is partitioned by month.
    """
    first = clock.day_start_utc(start)
    beyond = clock.day_start_utc(end + dt.timedelta(days=1))
    rows = df.where((F.col(time) >= F.lit(first)) & (F.col(time) < F.lit(beyond)))
    if MONTH in df.columns:
        months = F.col(MONTH).between(F.lit(first.date().replace(day=1)), F.lit(beyond.date()))
        rows = rows.where(months)
    return rows.where(clock.local_date(time).between(F.lit(start), F.lit(end)))


def filter_days(df: DataFrame, start: dt.date, end: dt.date, date: str = "date") -> DataFrame:
    """Rows of a daily table in [start, end]."""
    return df.where(F.to_date(date).between(F.lit(start), F.lit(end)))


def filter_cities(df: DataFrame, cities: Sequence[str]) -> DataFrame:
    return df.where(F.col("city").isin(*cities))


def sensor_summary(
    measurements: DataFrame, aqi: DataFrame, sensors: DataFrame, pollutant: str
) -> DataFrame:
    """Sensors with the mean and count of one pollutant and the mean and largest index."""
    value = to_number(pollutant)
    readings = measurements.groupBy("device_id").agg(
        F.avg(value).alias("value"), F.count(value).alias("n_readings")
    )
    index = aqi.groupBy("device_id").agg(F.avg("aqi").alias("avg_aqi"), F.max("aqi").alias("max_aqi"))
    return sensors.join(readings, "device_id", "left").join(index, "device_id", "left")


def summary_table(summary: DataFrame, label: str) -> DataFrame:
    """The table under the map: the value under its display name, largest first."""
    ranked = summary.orderBy(F.col("value").desc_nulls_last(), "device_id")
    return ranked.select(
        "device_id", "city", F.col("value").alias(label), "n_readings", "avg_aqi", "max_aqi"
    )


def map_markers(summary: DataFrame, label: str) -> DataFrame:
    """Marker position, radius, colour and texts of each sensor."""
    largest = summary.agg(F.max("value")).scalar()
    share = F.coalesce(ratio(F.col("value"), largest), F.lit(0.0))
    radius = F.when(F.col("value").isNull(), MIN_RADIUS).otherwise(MIN_RADIUS + RADIUS_RANGE * share)
    value_text = F.when(F.col("value").isNull(), "(no readings)").otherwise(
        F.concat(F.lit(f"{label}: "), half_even("value", 1).cast("decimal(20,1)").cast("string"))
    )
    return summary.select(
        "device_id",
        "latitude",
        "longitude",
        radius.alias("radius"),
        air_index.marker_color("avg_aqi").alias("color"),
        F.concat_ws(
            "<br>",
            F.concat(F.lit("<b>"), F.col("city"), F.lit("</b>")),
            F.concat(F.lit("Device: "), F.col("device_id")),
            value_text,
        ).alias("popup"),
        F.concat(F.col("city"), F.lit(" ("), F.col("device_id"), F.lit(")")).alias("tooltip"),
    )


def headline(measurements: DataFrame) -> DataFrame:
    """Readings, sensors and local dates covered by a selection."""
    day = clock.local_date("timestamp")
    return measurements.agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.count_distinct("device_id").alias("n_sensors"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def model_table(metrics: DataFrame, target: str) -> DataFrame:
    """Model comparison of one target, rounded for display."""
    chosen = metrics.where(F.col("target") == target)
    numbers = [half_even(c, 3).alias(c) for c in ("mae", "rmse", "r2", "train_seconds")]
    return chosen.orderBy("mae").select("model", *numbers)


def prediction_series(predictions: DataFrame, target: str, device: str) -> DataFrame:
    """(timestamp, series, value) of actual and predicted values of one sensor."""
    chosen = predictions.where((F.col("target") == target) & (F.col("device_id") == device))
    long = chosen.unpivot(["timestamp"], ["actual", "predicted"], "series", "value")
    return long.orderBy("timestamp", "series")


def sensor_mae(predictions: DataFrame) -> DataFrame:
    """Mean absolute error and number of hours per target and sensor."""
    return predictions.groupBy("target", "city", "device_id").agg(
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"),
        F.count(F.lit(1)).alias("n_hours"),
    )


def prediction_choices(predictions: DataFrame, target: str, cities: Sequence[str]) -> DataFrame:
    """Cities and sensors that have predictions of a target."""
    chosen = filter_cities(predictions.where(F.col("target") == target), cities)
    return chosen.select("city", "device_id").distinct().orderBy("city", "device_id")


def anomaly_list(
    anomalies: DataFrame, cities: Sequence[str], start: dt.date, end: dt.date
) -> DataFrame:
    """Anomalous days of some cities and a period, worst first."""
    return worst_days(filter_cities(filter_days(anomalies, start, end), cities), n=None)
