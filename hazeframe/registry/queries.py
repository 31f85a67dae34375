"""Every operator as a query over the whole test tables.

Doubles are rounded to six digits and timestamps given without zone, so that two engines can be compared; the
operators themselves return unrounded values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe import fixtures as fx
from hazeframe.functions import clock
from hazeframe.functions.numeric import to_number
from hazeframe.learning import dataset as ds
from hazeframe.learning import models, training
from hazeframe.operators import (
    air_quality,
    anomalies,
    cleaning,
    dashboard,
    distinct,
    fleet,
    profiles,
    quantiles,
    statistics,
    timeseries,
)
from hazeframe.operators.geo import nearest_settlement
from hazeframe.plans import ingest, rollups
from hazeframe.schema import COLUMN_MAP, MEASUREMENTS, measure_columns, raw_columns
from hazeframe.session import configure, cut_lineage, ensure_checkpoint_dir
from hazeframe.sources import exports, tables
from hazeframe.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

CHANNELS = [
    "pm25_raw", "pm25_24h_raw", "pm10_raw", "pm10_24h_raw", "no2_raw", "no2_aqi_epa",
    "temp_internal", "humidity_internal", "wind_speed", "pressure",
]
RAW = ["pm25_raw", "pm10_raw", "no2_raw"]
START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 12)
PERIODS = [(dt.date(1995 + i // 2, 1 + 5 * (i % 2), 3), dt.date(1995 + i // 2, 1 + 5 * (i % 2), 3 + 2 * i)) for i in range(10)]
CITIES = ["NATION_1", "NATION_3", "NATION_4"]
LABEL = "PM2.5 [ug/m3]"

QUERIES: dict[str, Query] = {}


def stable(df: DataFrame) -> DataFrame:
    """Engine-independent values. The small offset keeps decimal ties from depending on the last bit."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "double":
            column = F.round(column + 1e-10, 6)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return df.select(*columns)


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return stable(build(configure(spark), folder))

    QUERIES[build.__name__] = run
    return build


def pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return fx.readings(spark, folder), fx.sensors(spark, folder)


def long_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return fx.long_readings(spark, folder), fx.long_sensors(spark, folder)


# --- cleaning and sources -------------------------------------------------------------------


@query
def union_conform(spark, folder):
    parts = [
        exports.conform(fx.readings(spark, folder).withColumn("source_dataset", F.lit("events"))),
        exports.conform(fx.long_readings(spark, folder).withColumn("source_dataset", F.lit("orders"))),
    ]
    return exports.append(exports.empty_measurements(spark), *parts)


@query
def raw_channel_profile(spark, folder):
    """Mean of every hourly raw channel that the readings hold, by local hour."""
    measurements, sensors = pair(spark, folder)
    return profiles.diurnal_pattern(measurements, sensors, raw_columns(measure_columns(measurements)))


@query
def coerced_numbers(spark, folder):
    events = fx.source(spark, folder, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    return events.select("event_id", to_number(text).alias("number"))


@query
def parsed_timestamps(spark, folder):
    events = fx.source(spark, folder, "events").withColumn("t", F.col("ts").cast("timestamp"))
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, clock.iso_utc("t"))
        .when(kind == 1, F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format("t", "yyyy-MM-dd"))
        .otherwise(F.col("event_type"))
    )
    return events.select("event_id", exports.parse_timestamp(text).alias("parsed"))


@query
def dedupe_readings(spark, folder):
    rows = fx.duplicates(spark, folder)
    kept = cleaning.deduplicate(rows, tie_break=["event_id"])
    return kept.select("event_id", "device_id", "timestamp", "pm25_raw", "pm10_raw", "no2_raw")


@query
def stage_counts(spark, folder):
    rows = fx.duplicates(spark, folder)
    broken = F.when(F.col("event_id") % 50 != 0, F.col("timestamp"))
    return cleaning.stage_counts(rows.withColumn("timestamp", broken))


@query
def column_completeness(spark, folder):
    return cleaning.filled_counts(fx.readings(spark, folder), ["event_id", *CHANNELS])


@query
def missing_share(spark, folder):
    return statistics.missing_share(fx.readings(spark, folder), CHANNELS)


@query
def drop_empty(spark, folder):
    rows = fx.readings(spark, folder).select("event_id", "device_id", "timestamp", *CHANNELS, "o3_raw")
    return cleaning.drop_empty_columns(rows)


def exported(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Readings as two sets of CSV cells under the export's headers, the second with its columns the other way round.
    Readings of the first days are in both, and some have no readable time."""
    names = {name: header for header, name in COLUMN_MAP.items()}
    held = [c for c in fx.readings(spark, folder).columns if c in names]
    rows = fx.duplicates(spark, folder).withColumn("day", F.dayofmonth("timestamp"))
    text = F.when(F.col("event_id") % 50 == 0, F.lit("no time")).otherwise(clock.iso_utc("timestamp"))
    cells = rows.withColumn("timestamp", text)
    first, second = cells.where("day <= 16"), cells.where("day >= 15")
    return [part.select(*[F.col(c).alias(names[c]) for c in order]) for part, order in ((first, held), (second, held[::-1]))]


def scratch_root(spark: SparkSession) -> str:
    """A new folder for the tables of one query."""
    return f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4()}"


def loaded(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Root and counts of a fact table from written CSV files: of one folder first, then of both."""
    root = scratch_root(spark)
    folders = {}
    for label, part in zip(("first", "second"), exported(spark, folder)):
        folders[label] = f"{root}/csv/{label}"
        part.write.option("header", True).csv(folders[label])
        counts = ingest.load(spark, folders, root)
    return root, counts


@query
def loaded_exports(spark, folder):
    """Rows that come back from CSV files; where equally complete readings collide, only what tells none of them apart."""
    rows = read_table(spark, loaded(spark, folder)[0], "measurements")
    named = F.col("source_file").endswith(".csv").alias("named")
    filled = cleaning.completeness([c for c in MEASUREMENTS.names if c not in ("source_dataset", "source_file")])
    return rows.select("device_id", "timestamp", "utc_month", "latitude", "longitude", filled.alias("n_filled"), named)


@query
def loaded_counts(spark, folder):
    """Rows read, unusable, duplicate and kept, as committed with the table."""
    return loaded(spark, folder)[1]


def kept_state(spark: SparkSession, folder: str) -> str:
    """Root of a fact table and its partial sums, which followed it through three loads."""
    root = scratch_root(spark)
    rows = fx.long_readings(spark, folder)
    year = F.year("timestamp")
    tables.write_measurements(rows.where(year < 1998), root)
    rollups.refresh(spark, root)
    later = [str(r.m) for r in tables.with_month(rows.where(year >= 1998)).select(F.col("utc_month").alias("m")).distinct().collect()]
    tables.write_measurements(rows.where(year >= 1998), root, months=later)
    rollups.refresh(spark, root)
    return root


def kept_rollup(spark: SparkSession, folder: str, *key, **options) -> DataFrame:
    sums = read_table(spark, kept_state(spark, folder), rollups.STATE)
    return rollups.rollup(sums, fx.long_sensors(spark, folder), list(profiles.PROFILE_COLUMNS), *key, **options)


@query
def kept_daily_city_avg(spark, folder):
    return kept_rollup(spark, folder, "date")


@query
def kept_monthly_city_avg(spark, folder):
    return kept_rollup(spark, folder, "month")


@query
def kept_seasonal(spark, folder):
    return kept_rollup(spark, folder, "month", by_city=False)


@query
def kept_weekly(spark, folder):
    return kept_rollup(spark, folder, "weekday", by_city=False)


@query
def kept_diurnal(spark, folder):
    return kept_rollup(spark, folder, "hour", by_city=False)


@query
def kept_ranking(spark, folder):
    return kept_rollup(spark, folder)


@query
def kept_devices(spark, folder):
    """Devices and cities that sent something in ten periods, from stored sketches of each city and day."""
    root = kept_state(spark, folder)
    readings = read_table(spark, root, "measurements")
    tables.write_table(distinct.daily_sketches(readings, fx.long_sensors(spark, folder), "device_id"), root, "device_sketches")
    kept = read_table(spark, root, "device_sketches")
    return exports.append(*(distinct.estimate(kept, *period) for period in PERIODS))


# --- sensors --------------------------------------------------------------------------------


@query
def sensor_coordinates(spark, folder):
    return fleet.sensor_coordinates(fx.readings(spark, folder))


@query
def distinct_places(spark, folder):
    return fleet.sensor_coordinates(fx.long_readings(spark, folder), keep_moves=True)


@query
def nearest_place(spark, folder):
    places = fx.readings(spark, folder).select("latitude", "longitude").distinct()
    return nearest_settlement(places, fx.gazetteer(spark, folder))


@query
def build_sensors(spark, folder):
    return fleet.build_sensors(fx.readings(spark, folder), fx.gazetteer(spark, folder))


@query
def located_readings(spark, folder):
    joined = fleet.located_readings(*pair(spark, folder), ["pm25_raw", "no2_raw"], ["city", "region"], salt=4)
    return joined.drop("local_time").withColumn("local_hour", clock.local_hour("timestamp"))


# --- rollups and profiles -------------------------------------------------------------------


@query
def daily_city_avg(spark, folder):
    return profiles.daily_city_avg(*pair(spark, folder), CHANNELS)


@query
def daily_preview(spark, folder):
    return profiles.preview(profiles.daily_city_avg(*pair(spark, folder), ["pm25_raw", "pm10_raw"]))


@query
def monthly_city_avg(spark, folder):
    return profiles.monthly_city_avg(*long_pair(spark, folder), ["pm25_raw", "pm10_raw"])


@query
def diurnal(spark, folder):
    return profiles.diurnal_pattern(*pair(spark, folder), RAW)


@query
def city_diurnal(spark, folder):
    return profiles.city_diurnal(*pair(spark, folder), ["pm25_raw"])


@query
def weekly(spark, folder):
    return profiles.weekly_pattern(*pair(spark, folder), RAW)


@query
def seasonal(spark, folder):
    return profiles.seasonal_pattern(*long_pair(spark, folder))


@query
def city_ranking(spark, folder):
    return profiles.city_ranking(*pair(spark, folder), RAW)


@query
def city_extremes(spark, folder):
    return profiles.city_extremes(profiles.city_ranking(*pair(spark, folder)))


@query
def peak_hour(spark, folder):
    return profiles.peaks(profiles.diurnal_pattern(*pair(spark, folder), RAW), "hour", RAW)


@query
def peak_month(spark, folder):
    columns = list(profiles.PROFILE_COLUMNS)
    return profiles.peaks(profiles.seasonal_pattern(*long_pair(spark, folder)), "month", columns)


@query
def weekend_contrast(spark, folder):
    return profiles.weekend_contrast(profiles.weekly_pattern(*pair(spark, folder), ["pm25_raw"]))


@query
def season_contrast(spark, folder):
    return profiles.season_contrast(profiles.seasonal_pattern(*long_pair(spark, folder)))


# --- statistics -----------------------------------------------------------------------------


@query
def describe(spark, folder):
    return statistics.descriptive_stats(fx.readings(spark, folder), CHANNELS)


@query
def column_quantiles(spark, folder):
    lines = fx.source(spark, folder, "lineitem")
    return quantiles.exact_quantiles(lines, ["l_extendedprice", "l_quantity"], [0.01, 0.25, 0.5, 0.8, 0.999])


@query
def skew(spark, folder):
    return statistics.skewness(fx.readings(spark, folder), CHANNELS)


@query
def iqr_outliers(spark, folder):
    return statistics.iqr_outliers(fx.readings(spark, folder), CHANNELS)


@query
def histogram(spark, folder):
    return statistics.histogram(fx.readings(spark, folder), CHANNELS)


@query
def corr_matrix(spark, folder):
    return statistics.correlation_matrix(fx.readings(spark, folder), CHANNELS)


@query
def strongest_pair(spark, folder):
    return statistics.strongest_pair(statistics.correlation_pairs(fx.readings(spark, folder), CHANNELS))


@query
def target_corr(spark, folder):
    matrix = statistics.correlation_matrix(fx.readings(spark, folder), CHANNELS)
    return statistics.target_correlations(matrix, "pm25_raw")


@query
def best_partner(spark, folder):
    return statistics.best_partner(statistics.correlation_matrix(fx.readings(spark, folder), CHANNELS), RAW)


@query
def linear_fit(spark, folder):
    return statistics.paired_fit(fx.readings(spark, folder), "humidity_internal", "pm25_raw")


@query
def fit_line(spark, folder):
    return statistics.fit_line(statistics.paired_fit(fx.readings(spark, folder), "humidity_internal", "pm25_raw"))


@query
def impossible_values(spark, folder):
    return statistics.impossible_values(fx.readings(spark, folder))


@query
def sampled_pairs(spark, folder):
    return statistics.sampled_pairs(fx.readings(spark, folder), "humidity_internal", "pm25_raw", ["event_id"])


# --- index ----------------------------------------------------------------------------------


@query
def reading_aqi(spark, folder):
    return air_quality.reading_aqi(*pair(spark, folder), extra=["event_id"])


@query
def daily_city_aqi(spark, folder):
    return air_quality.daily_city_aqi(air_quality.reading_aqi(*pair(spark, folder)))


@query
def aqi_heatmap(spark, folder):
    daily = air_quality.daily_city_aqi(air_quality.reading_aqi(*pair(spark, folder)))
    return air_quality.aqi_heatmap(daily)


@query
def aqi_cross_check(spark, folder):
    return air_quality.cross_checks(*pair(spark, folder))


@query
def category_share(spark, folder):
    return air_quality.category_share(air_quality.reading_aqi(*pair(spark, folder)))


@query
def unhealthy_share(spark, folder):
    return air_quality.unhealthy_share(air_quality.reading_aqi(*pair(spark, folder)))


@query
def top_dominant(spark, folder):
    return air_quality.top_dominant(air_quality.reading_aqi(*pair(spark, folder)))


@query
def category_days(spark, folder):
    daily = air_quality.daily_city_aqi(air_quality.reading_aqi(*pair(spark, folder)))
    return profiles.pair_counts(daily, "city", "aqi_category")


@query
def dominant_counts(spark, folder):
    return profiles.pair_counts(air_quality.reading_aqi(*pair(spark, folder)), "city", "dominant_pollutant")


@query
def value_counts(spark, folder):
    aqi = air_quality.reading_aqi(*pair(spark, folder))
    return profiles.value_counts(aqi, "aqi_category", keep_nulls=True)


# --- filters, counts, map -------------------------------------------------------------------


@query
def period_filter(spark, folder):
    joined = fleet.located_readings(*pair(spark, folder), RAW).drop("local_time")
    return dashboard.filter_cities(dashboard.filter_period(joined, START, END), CITIES)


@query
def headline(spark, folder):
    joined = fleet.located_readings(*pair(spark, folder), RAW)
    return dashboard.headline(dashboard.filter_period(joined, START, END))


@query
def distinct_counts(spark, folder):
    joined = fleet.located_readings(*pair(spark, folder), RAW)
    return profiles.distinct_counts(joined, ["device_id", "city"])


@query
def distinct_values(spark, folder):
    return profiles.distinct_values(fx.sensors(spark, folder), "city")


@query
def time_span(spark, folder):
    return profiles.span(fx.readings(spark, folder), "timestamp")


@query
def sensor_summary(spark, folder):
    measurements, sensors = pair(spark, folder)
    aqi = air_quality.reading_aqi(measurements, sensors)
    return dashboard.sensor_summary(measurements, aqi, sensors, "pm25_raw")


@query
def summary_table(spark, folder):
    measurements, sensors = pair(spark, folder)
    aqi = air_quality.reading_aqi(measurements, sensors)
    return dashboard.summary_table(dashboard.sensor_summary(measurements, aqi, sensors, "pm10_raw"), "pm10")


@query
def map_markers(spark, folder):
    measurements, sensors = pair(spark, folder)
    aqi = air_quality.reading_aqi(measurements, sensors)
    return dashboard.map_markers(dashboard.sensor_summary(measurements, aqi, sensors, "pm25_raw"), LABEL)


# --- time series ----------------------------------------------------------------------------


@query
def hourly_grid(spark, folder):
    return timeseries.hourly_grid(*pair(spark, folder), ["pm25_raw", "no2_raw"])


@query
def resample_hour(spark, folder):
    return timeseries.resample(*pair(spark, folder), ["pm25_raw"], "hour")


@query
def resample_day(spark, folder):
    return timeseries.resample(*long_pair(spark, folder), ["pm25_raw"], "day")


@query
def resample_month(spark, folder):
    return timeseries.resample(*long_pair(spark, folder), ["pm25_raw", "pm10_raw"], "month")


@query
def lag_features(spark, folder):
    grid = timeseries.hourly_grid(*pair(spark, folder), ["pm25_raw"], margin=(timeseries.REACH, 1))
    featured = timeseries.lag_features(grid, "pm25_raw")
    return timeseries.own_rows(featured.withColumn("target", timeseries.lagged("pm25_raw", -1, timeseries.series_keys(grid))))


@query
def rolling_features(spark, folder):
    grid = timeseries.hourly_grid(*pair(spark, folder), ["pm25_raw"], margin=(timeseries.REACH, 0))
    return timeseries.own_rows(timeseries.rolling_features(grid, "pm25_raw"))


@query
def calendar_features(spark, folder):
    return timeseries.calendar_features(fx.long_readings(spark, folder).select("order_id", "timestamp"))


@query
def calendar_fields(spark, folder):
    return fx.readings(spark, folder).select(
        "event_id",
        clock.weekday_name("timestamp").alias("weekday"),
        clock.local_month("timestamp").alias("month"),
        clock.local_date("timestamp").alias("date"),
        clock.local_hour("timestamp").alias("hour"),
        clock.iso_utc("timestamp").alias("iso"),
    )


# --- anomalies ------------------------------------------------------------------------------


def city_days(spark, folder):
    return profiles.daily_city_avg(*pair(spark, folder), ["pm25_raw", "pm10_raw"])


@query
def robust_z(spark, folder):
    return timeseries.robust_z(city_days(spark, folder), "pm25_raw", "z_pm25")


def located(spark, folder):
    measurements, sensors = pair(spark, folder)
    rows = measurements.select("event_id", "device_id", "timestamp", "pm25_raw", "no2_raw")
    return fleet.join_sensors(rows, sensors)


@query
def reading_robust_z(spark, folder):
    """Deviation of every single reading within its city, whose readings no task holds all of."""
    scored = timeseries.robust_z_of_groups(located(spark, folder), "no2_raw", "z_no2", most=500)
    return scored.select("event_id", "city", "z_no2")


@query
def city_quantiles(spark, folder):
    return quantiles.quantiles_by_group(located(spark, folder), ["city"], "no2_raw", [0.05, 0.25, 0.5, 0.75, 0.99], most=500)


@query
def detected_anomalies(spark, folder):
    return anomalies.detect_anomalies(city_days(spark, folder))


@query
def worst_days(spark, folder):
    return anomalies.worst_days(anomalies.detect_anomalies(city_days(spark, folder)))


@query
def anomaly_list(spark, folder):
    found = anomalies.detect_anomalies(city_days(spark, folder))
    return dashboard.anomaly_list(found, CITIES, START, END)


@query
def severity_counts(spark, folder):
    return profiles.value_counts(anomalies.detect_anomalies(city_days(spark, folder)), "severity")


@query
def anomalies_per_city(spark, folder):
    return profiles.value_counts(anomalies.detect_anomalies(city_days(spark, folder)), "city")


# --- learning -------------------------------------------------------------------------------


@query
def feature_matrix(spark, folder):
    return ds.build_dataset(*pair(spark, folder), "pm25_raw")


@query
def feature_overview(spark, folder):
    return ds.dataset_overview(ds.build_dataset(*pair(spark, folder), "pm10_raw"))


@query
def missing_features(spark, folder):
    data = ds.build_dataset(*pair(spark, folder), "pm25_raw")
    return ds.missing_feature_share(data, ds.feature_columns(data))


@query
def time_split(spark, folder):
    data = ds.build_dataset(*pair(spark, folder), "pm25_raw")
    train, test = ds.time_split(data)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


@query
def persistence_metrics(spark, folder):
    _, test = ds.time_split(ds.build_dataset(*pair(spark, folder), "pm25_raw"))
    return ds.evaluate(training.persistence(test, "pm25_raw"), "target", "prediction")


def persistence_predictions(spark, folder):
    _, test = ds.time_split(ds.build_dataset(*pair(spark, folder), "pm25_raw"))
    scored = training.persistence(test, "pm25_raw")
    return training.predictions_table(scored, "pm25_raw", training.BASELINE)


@query
def prediction_long(spark, folder):
    return dashboard.prediction_series(persistence_predictions(spark, folder), "pm25_raw", "view-1")


@query
def prediction_choices(spark, folder):
    return dashboard.prediction_choices(persistence_predictions(spark, folder), "pm25_raw", CITIES)


@query
def persistence_by_sensor(spark, folder):
    return dashboard.sensor_mae(persistence_predictions(spark, folder))


@query
def persistence_table(spark, folder):
    scores = ds.evaluate(persistence_predictions(spark, folder), "actual", "predicted", ["target", "model"])
    return dashboard.model_table(scores.withColumn("train_seconds", F.lit(0.0)), "pm25_raw")


def one_model(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Metrics of one candidate against the baseline."""
    trainers = {name: training.TRAINERS[name]}
    return training.run_target(*pair(spark, folder), "pm25_raw", trainers).metrics


@query
def ridge_metrics(spark, folder):
    return one_model(spark, folder, "Ridge")


@query
def forest_metrics(spark, folder):
    return one_model(spark, folder, "RandomForest")


@query
def boosting_metrics(spark, folder):
    return one_model(spark, folder, "HistGradientBoosting")


@query
def network_metrics(spark, folder):
    return one_model(spark, folder, "MLP")


def trained(spark: SparkSession, folder: str) -> list[training.TargetRun]:
    """All models of both targets, side by side: only `train_seconds` suffers from that."""
    return training.run_targets(*pair(spark, folder), together=True)


@query
def model_metrics(spark, folder):
    return training.all_metrics(trained(spark, folder))


@query
def best_models(spark, folder):
    metrics = [training.best_model(run.metrics) for run in trained(spark, folder)]
    return exports.append(*metrics)


@query
def model_predictions(spark, folder):
    return training.all_predictions(trained(spark, folder))


@query
def model_sensor_mae(spark, folder):
    return dashboard.sensor_mae(training.all_predictions(trained(spark, folder)))


# --- what the models see --------------------------------------------------------------------


def train_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ds.time_split(ds.build_dataset(*pair(spark, folder), "pm25_raw"))[0]


@query
def train_medians(spark, folder):
    """The values that fill missing features."""
    rows = train_rows(spark, folder)
    return quantiles.exact_quantiles(rows, ds.feature_columns(rows), [0.5]).select("column", "value")


@query
def standardised_features(spark, folder):
    """Training rows as the linear models see them: filled, centred, in units of their deviation."""
    rows = cut_lineage(train_rows(spark, folder))
    fills = models.fill_values(rows, ds.feature_columns(rows))
    prepared = Pipeline(stages=models.scaled_features(fills)).fit(rows).transform(rows)
    cells = vector_to_array("features")
    return prepared.select("device_id", "timestamp", *[cells[i].alias(c) for i, c in enumerate(fills)])


@query
def ridge_coefficients(spark, folder):
    """Weights and intercept of a ridge over two features, which SQL can solve as well."""
    rows = cut_lineage(train_rows(spark, folder))
    fitted = models.ridge(rows, models.fill_values(rows, ["pm25_raw", "lag_1h"])).stages[-1]
    named = [*zip(["pm25_raw", "lag_1h"], fitted.coefficients.tolist()), ("intercept", fitted.intercept)]
    return spark.createDataFrame([(name, float(value)) for name, value in named], "term string, weight double")


@query
def held_out_truth(spark, folder):
    """Keys and truth of the rows that every model predicts, for both targets."""
    parts = []
    for target in training.TARGETS:
        _, test = ds.time_split(ds.build_dataset(*pair(spark, folder), target))
        predicted = training.predictions_table(training.persistence(test, target), target, training.BASELINE)
        parts.append(predicted.drop("predicted", "model"))
    return exports.append(*parts)
