"""Rollups, profiles and rankings of measurement columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.functions import clock
from hazeframe.functions.numeric import by_label_order, ratio
from hazeframe.operators.fleet import mean_by

PROFILE_COLUMNS = ("pm25_raw", "pm10_raw")


def daily_city_avg(measurements: DataFrame, sensors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(city, local date) means, ordered."""
    keys = {"date": clock.local_date("timestamp")}
    return mean_by(measurements, sensors, columns, keys).orderBy("city", "date")


def monthly_city_avg(measurements: DataFrame, sensors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(city, local yyyy-MM) means, ordered."""
    keys = {"month": clock.local_month("timestamp")}
    return mean_by(measurements, sensors, columns, keys).orderBy("city", "month")


def diurnal_pattern(
    measurements: DataFrame, sensors: DataFrame, columns: Sequence[str] = PROFILE_COLUMNS
) -> DataFrame:
    """Mean per local hour over all sensors."""
    keys = {"hour": clock.local_hour("timestamp")}
    return mean_by(measurements, sensors, columns, keys, by_city=False).orderBy("hour")


def city_diurnal(measurements: DataFrame, sensors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean per city and local hour."""
    keys = {"hour": clock.local_hour("timestamp")}
    return mean_by(measurements, sensors, columns, keys).orderBy("city", "hour")


def weekly_pattern(measurements: DataFrame, sensors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean per weekday name, Monday first."""
    keys = {"weekday": clock.weekday_name("timestamp")}
    profile = mean_by(measurements, sensors, columns, keys, by_city=False)
    return profile.orderBy(by_label_order("weekday", clock.WEEKDAYS))


def seasonal_pattern(
    measurements: DataFrame, sensors: DataFrame, columns: Sequence[str] = PROFILE_COLUMNS
) -> DataFrame:
    """Mean per local month over all sensors."""
    keys = {"month": clock.local_month("timestamp")}
    return mean_by(measurements, sensors, columns, keys, by_city=False).orderBy("month")


def city_ranking(
    measurements: DataFrame, sensors: DataFrame, columns: Sequence[str] = ("pm25_raw",)
) -> DataFrame:
    """City means, worst first by the first column; cities without a value of it come last."""
    means = mean_by(measurements, sensors, columns, {})
    return means.orderBy(F.col(columns[0]).desc_nulls_last(), "city")


def city_extremes(ranking: DataFrame, column: str = "pm25_raw") -> DataFrame:
    """One row: worst and best city, their means and ratio, and how many cities have no value."""
    value = F.col(column)
    worst, best = F.max(value), F.min(value)
    # Ties go to the alphabetically first city.
    at_worst = F.min(F.when(value.isNotNull(), F.struct(-value, "city")))
    at_best = F.min(F.when(value.isNotNull(), F.struct(value, F.col("city"))))
    return ranking.agg(
        at_worst["city"].alias("worst_city"),
        worst.alias("worst_value"),
        at_best["city"].alias("best_city"),
        best.alias("best_value"),
        ratio(worst, best).alias("ratio"),
        (F.count(F.lit(1)) - F.count(value)).alias("n_cities_without_value"),
    )


def peaks(profile: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """(column, peak label, peak value) of a profile; the earliest label wins ties."""
    long = profile.unpivot([label], list(columns), "column", "value").where("value IS NOT NULL")
    first_peak = F.min(F.struct((-F.col("value")).alias("low"), F.col(label).alias("label")))
    return (
        long.groupBy("column")
        .agg(first_peak.alias("peak"))
        .select("column", F.col("peak.label").alias("peak_at"), (-F.col("peak.low")).alias("peak_value"))
    )


def weekend_contrast(weekly: DataFrame, column: str = "pm25_raw") -> DataFrame:
    """Mean of the weekday means against mean of the weekend means, and the difference in percent."""
    weekend = F.col("weekday").isin(*clock.WEEKDAYS[5:])
    workdays = F.avg(F.when(~weekend, F.col(column)))
    weekends = F.avg(F.when(weekend, F.col(column)))
    return weekly.agg(
        workdays.alias("weekday_avg"),
        weekends.alias("weekend_avg"),
        (ratio(workdays - weekends, weekends) * 100).alias("diff_pct"),
    )


def _mean_in_months(column: str, months: Sequence[str]) -> Column:
    return F.avg(F.when(F.substring("month", 6, 2).isin(*months), F.col(column)))


def season_contrast(seasonal: DataFrame, column: str = "pm25_raw") -> DataFrame:
    """Mean of the winter months' means (Nov-Feb) against the summer months' (Jun-Aug)."""
    winter = _mean_in_months(column, clock.WINTER_MONTHS)
    summer = _mean_in_months(column, clock.SUMMER_MONTHS)
    return seasonal.agg(
        winter.alias("winter_avg"), summer.alias("summer_avg"), ratio(winter, summer).alias("ratio")
    )


def value_counts(df: DataFrame, column: str, keep_nulls: bool = False) -> DataFrame:
    """(value, n), most frequent first.

    The NULL group is recognised by its count of values. A filter on the column itself would be pushed below
    the expressions that compute it and evaluate them twice.
    """
    counted = F.count(F.lit(1)) if keep_nulls else F.count(column)
    counts = df.groupBy(column).agg(counted.alias("n")).where("n > 0")
    return counts.orderBy(F.col("n").desc(), F.col(column).asc_nulls_last())


def pair_counts(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, n) over rows where both are known."""
    known = F.count(F.when(F.col(group).isNotNull(), F.col(label)))
    return df.groupBy(group, label).agg(known.alias("n")).where("n > 0").orderBy(group, label)


def span(df: DataFrame, column: str) -> DataFrame:
    """First and last value of a date or time column."""
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def distinct_counts(df: DataFrame, columns: Sequence[str], accuracy: float | None = None) -> DataFrame:
    """Distinct non-null values per column: exact, or HyperLogLog with relative error `accuracy`."""
    if accuracy is None:
        counts = [F.count_distinct(c).alias(f"n_{c}") for c in columns]
    else:
        counts = [F.approx_count_distinct(c, accuracy).alias(f"n_{c}") for c in columns]
    return df.agg(*counts)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
