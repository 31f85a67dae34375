"""Unusual and unhealthy city-days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.functions.numeric import any_true, half_even
from hazeframe.operators.timeseries import robust_z

# Z limit and the EPA 24-hour "unhealthy" concentrations.
Z_LIMIT = 3.0
PM25_LIMIT = 55.4
PM10_LIMIT = 154.0
COLUMNS = (
    "city", "date", "pm25_raw", "pm10_raw", "z_pm25", "z_pm10",
    "is_statistical", "is_threshold", "severity",
)


def flag_days(daily: DataFrame) -> DataFrame:
    """Every city-day with its robust z-scores and both criteria."""
    days = daily.where(F.col("city").isNotNull()).select("city", "date", "pm25_raw", "pm10_raw")
    scored = robust_z(robust_z(days, "pm25_raw", "z_pm25"), "pm10_raw", "z_pm10")
    return scored.withColumns(
        {
            "is_statistical": any_true(F.abs("z_pm25") > Z_LIMIT, F.abs("z_pm10") > Z_LIMIT),
            "is_threshold": any_true(F.col("pm25_raw") > PM25_LIMIT, F.col("pm10_raw") > PM10_LIMIT),
        }
    )


def detect_anomalies(daily: DataFrame) -> DataFrame:
    """`anomalies` table: days that meet a criterion, with their severity."""
    severity = (
        F.when(F.col("is_statistical") & F.col("is_threshold"), "extreme")
        .when(F.col("is_threshold"), "unhealthy")
        .otherwise("unusual")
    )
    flagged = flag_days(daily).where(F.col("is_statistical") | F.col("is_threshold"))
    return flagged.withColumn("severity", severity).select(*COLUMNS)


def worst_days(anomalies: DataFrame, n: int | None = 10) -> DataFrame:
    """Worst days by PM2.5, rounded for display; all of them if `n` is None."""
    ranked = anomalies.orderBy(F.col("pm25_raw").desc_nulls_last(), "city", "date")
    if n is not None:
        ranked = ranked.limit(n)
    return ranked.select(
        "city",
        "date",
        half_even("pm25_raw", 1).alias("pm25_raw"),
        half_even("pm10_raw", 1).alias("pm10_raw"),
        "severity",
    )
