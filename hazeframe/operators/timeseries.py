"""Gap-free grids, lags, rolling statistics and robust z-scores.

Readings are first averaged per device (or city) and hour, combined before the shuffle. What reaches a
window is therefore bounded by the calendar (8,784 rows per device and year), not by the number of readings,
even for a device that holds a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions import clock
from hazeframe.functions.numeric import ratio, to_number
from hazeframe.operators.fleet import join_sensors, mean_by
from hazeframe.operators.quantiles import WINDOW, quantiles_by_group, spread_out

LAGS = (1, 2, 3, 6, 12, 24)
ROLLING_HOURS = (3, 24)
MAD_SCALE = 0.6745
#: Hours that lags and rolling statistics look back.
REACH = 24
#: First step of the part of a grid that windows stay in, and what a part is for each step.
PART = "_part"
PARTS = {"hour": "month", "day": "year", "month": "year"}
STEPS = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH"}


def fill_gaps(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    step: str = "hour",
    partition: Sequence[str] | None = None,
    margin: tuple[int, int] | None = None,
) -> DataFrame:
    """Adds a row of NULLs for every missing step between the first and last row of each key.

    Each row is extended up to its successor, in two levels: it is cut at the turn of months (of years for days and
    months), the pieces are dealt out anew, and only then become steps. So no row holds more steps than a month has hours, and a
    gap of centuries is filled by as many tasks as it has months. `partition` names the keys to shuffle by, all of them by
    default.

    With `margin` (back, ahead) the result keeps PART, the first step of the month or year, and each part begins so many steps early and
    ends so many late: windows within (partition, PART) then see as far as windows within the partition. See `own_rows`.
    """
    partition = list(keys if partition is None else partition)
    rest = [k for k in keys if k not in partition]
    in_order = Window.partitionBy(*partition).orderBy(*rest, time)
    following = F.lead(time).over(in_order)
    for key in rest:
        following = F.when(F.lead(key).over(in_order) == F.col(key), following)
    kind = df.schema[time].dataType
    every, unit = F.expr(STEPS[step]), PARTS[step]
    back, ahead = (F.expr(f"INTERVAL {n} {step.upper()}") for n in margin or (0, 0))
    last = F.coalesce(following - every, F.col(time)).cast(kind)
    parts = F.sequence(
        F.date_trunc(unit, F.col(time) - ahead), F.date_trunc(unit, F.col("_last") + back), F.expr(f"INTERVAL 1 {unit.upper()}")
    )
    end = F.col(PART) + F.expr(f"INTERVAL 1 {unit.upper()}") - every
    # By number: what is shuffled here is smaller than what it becomes, so Spark must not merge partitions by size.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (
        df.withColumn("_last", last)
        .withColumn(PART, F.explode(F.transform(parts, lambda part: part.cast(kind))))
        .withColumn("_from", F.greatest(F.col(time), (F.col(PART) - back).cast(kind)))
        .withColumn("_to", F.least(F.col("_last"), (end + ahead).cast(kind)))
        .where("_from <= _to")
        .repartition(tasks, *partition, PART)
    )
    kept = [PART] if margin else []
    return pieces.withColumn("_slot", F.explode(F.sequence(F.col("_from"), F.col("_to"), every))).select(
        *keys,
        *kept,
        F.col("_slot").alias(time),
        *[F.when(F.col("_slot") == F.col(time), F.col(v)).alias(v) for v in values],
    )


def own_rows(grid: DataFrame, time: str = "timestamp", step: str = "hour") -> DataFrame:
    """A grid with margins without them: each step once."""
    own = F.date_trunc(PARTS[step], time).cast(grid.schema[PART].dataType) == F.col(PART)
    return grid.where(own).drop(PART)


def hourly_grid(
    measurements: DataFrame, sensors: DataFrame, columns: Sequence[str], margin: tuple[int, int] | None = None
) -> DataFrame:
    """One row per device, city and UTC hour with hourly means; hours without readings are NULL.

    The grid is partitioned by device and month. With `margin` its months overlap by so many hours, for lags and rolling
    statistics that need no further shuffle. Margins count hours: over the gap that a sensor leaves between two cities
    (`keep_moves`), windows of the later month don't reach.
    """
    hour = F.date_trunc("hour", "timestamp").alias("timestamp")
    hourly = measurements.groupBy("device_id", hour).agg(
        *[F.avg(to_number(c)).alias(c) for c in columns]
    )
    located = join_sensors(hourly, sensors).where(F.col("city").isNotNull())
    return fill_gaps(located, ["device_id", "city"], "timestamp", columns, partition=["device_id"], margin=margin)


def resample(
    measurements: DataFrame, sensors: DataFrame, columns: Sequence[str], step: str
) -> DataFrame:
    """City means per UTC hour, local day or local month, with empty steps kept as NULL."""
    starts = {
        "hour": F.date_trunc("hour", "timestamp"),
        "day": clock.local_date("timestamp"),
        "month": F.trunc(clock.local_date("timestamp"), "month"),
    }
    means = mean_by(measurements, sensors, columns, {"start": starts[step]})
    return fill_gaps(means, ["city"], "start", columns, step)


def series_keys(grid: DataFrame) -> list[str]:
    """What the windows of a grid are partitioned by: the device, and the month where months overlap."""
    return [c for c in ("device_id", PART) if c in grid.columns]


def lagged(column: str, hours: int, by: Sequence[str] = ("device_id",)) -> Column:
    """Value some hours ago; negative hours look ahead."""
    return F.lag(column, hours).over(Window.partitionBy(*by).orderBy("timestamp"))


def rolling(column: str, hours: int, statistic, by: Sequence[str] = ("device_id",)) -> Column:
    """Statistic over strictly past hours, NULL until half of them (at least one) hold a value."""
    past = Window.partitionBy(*by).orderBy("timestamp").rowsBetween(-hours, -1)
    enough = F.count(column).over(past) >= max(1, hours // 2)
    return F.when(enough, statistic(column).over(past))


def lag_features(grid: DataFrame, column: str, lags: Sequence[int] = LAGS) -> DataFrame:
    """lag_{k}h columns and the change over the last three hours."""
    lags_added = {f"lag_{k}h": lagged(column, k, series_keys(grid)) for k in lags}
    return grid.withColumns(lags_added).withColumn("delta_3h", F.col(column) - F.col("lag_3h"))


def rolling_features(
    grid: DataFrame, column: str, windows: Sequence[int] = ROLLING_HOURS
) -> DataFrame:
    """roll_mean_{w}h and roll_std_{w}h columns."""
    added = {}
    for hours in windows:
        added[f"roll_mean_{hours}h"] = rolling(column, hours, F.avg, series_keys(grid))
        added[f"roll_std_{hours}h"] = rolling(column, hours, F.stddev_samp, series_keys(grid))
    return grid.withColumns(added)


def calendar_features(grid: DataFrame) -> DataFrame:
    """Cyclic hour and month, weekday, weekend and heating-season flags, all in local time."""
    local = clock.local_time("timestamp")
    hour_sin, hour_cos = clock.on_circle(F.hour(local), 24)
    month_sin, month_cos = clock.on_circle(F.month(local), 12)
    return grid.withColumns(
        {
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "day_of_week": clock.local_weekday("timestamp"),
            "is_weekend": clock.is_weekend("timestamp"),
            "month_sin": month_sin,
            "month_cos": month_cos,
            "is_heating_season": clock.is_heating_season("timestamp"),
        }
    )


def robust_z(daily: DataFrame, column: str, output: str, by: str = "city") -> DataFrame:
    """Adds 0.6745 * (x - median) / MAD within each group; NULL where the MAD is 0 or missing.

    Meant for daily rows: a group is as long as the calendar, so one task can hold it. For groups of any size see
    `robust_z_of_groups`.
    """
    group = Window.partitionBy(by)
    deviation = F.col(column) - F.median(column).over(group)
    return (
        daily.withColumn("_deviation", deviation)
        .withColumn("_mad", F.median(F.abs("_deviation")).over(group))
        .withColumn(output, ratio(F.lit(MAD_SCALE) * F.col("_deviation"), F.col("_mad")))
        .drop("_deviation", "_mad")
    )


def robust_z_of_groups(df: DataFrame, column: str, output: str, by: str = "city", most: int = WINDOW) -> DataFrame:
    """As `robust_z`, for groups of any size: no task sorts more than `most` values of one. Rows without a group have no z."""
    middle = spread_out(quantiles_by_group(df, [by], column, [0.5], most).select(by, F.col("value").alias("_median")))
    centred = df.join(middle, by, "left").withColumn("_deviation", to_number(column) - F.col("_median"))
    sizes = quantiles_by_group(centred.withColumn("_size", F.abs("_deviation")), [by], "_size", [0.5], most)
    scale = spread_out(sizes.select(by, F.col("value").alias("_mad")))
    z = ratio(F.lit(MAD_SCALE) * F.col("_deviation"), F.col("_mad"))
    return centred.join(scale, by, "left").withColumn(output, z).drop("_median", "_deviation", "_mad")
