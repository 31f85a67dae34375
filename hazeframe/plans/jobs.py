"""The jobs a user runs, in this order: load, locate, aggregate, describe, index, train, anomalies.

Each job reads tables under a root folder and commits new versions of those it owns, so it can be rerun at any time, and
readers see a table before or after a job but never in between. `drop_old` frees what older versions hold.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from hazeframe.learning import training
from hazeframe.operators import air_quality, anomalies, cleaning, fleet, profiles, statistics
from hazeframe.plans import ingest, rollups
from hazeframe.schema import measure_columns
from hazeframe.sources.tables import drop_old_versions, read_table, table_exists, write_measurements, write_report, write_table


def _fact(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, root, "measurements"), read_table(spark, root, "sensors")


def filled_measure_columns(measurements: DataFrame) -> list[str]:
    """Measurement columns that hold at least one value."""
    empty = set(cleaning.empty_columns(measurements.select(*measure_columns(measurements))))
    return [c for c in measure_columns(measurements) if c not in empty]


def load(spark: SparkSession, folders: Mapping[str, str], root: str, **csv_options: str) -> DataFrame:
    """CSV folders (label -> path) -> `measurements`. Returns the counts of each stage.

    Files that are listed with the table and haven't changed aren't read again; see `ingest.load`.
    """
    return ingest.load(spark, folders, root, **csv_options)


def locate(spark: SparkSession, gazetteer: DataFrame, root: str, keep_moves: bool = False) -> None:
    """`measurements` + gazetteer -> `sensors`."""
    measurements = read_table(spark, root, "measurements")
    write_table(fleet.build_sensors(measurements, gazetteer, keep_moves), root, "sensors")


def aggregate(spark: SparkSession, root: str) -> None:
    """-> `daily_city_avg`, `monthly_city_avg`, from `hourly_sums`, which is brought up to date first."""
    rollups.refresh(spark, root)
    sums, sensors = read_table(spark, root, rollups.STATE), read_table(spark, root, "sensors")
    columns = rollups.filled_columns(sums)
    write_table(rollups.rollup(sums, sensors, columns, "date"), root, "daily_city_avg")
    write_table(rollups.rollup(sums, sensors, columns, "month"), root, "monthly_city_avg")


def describe(spark: SparkSession, root: str, report_root: str) -> None:
    """-> five CSV reports."""
    measurements, sensors = _fact(spark, root)
    columns = filled_measure_columns(measurements)
    readings = fleet.located_readings(measurements, sensors, columns)
    reports = {
        "descriptive_stats": statistics.descriptive_stats(readings, columns).drop("skew"),
        "correlation_matrix": statistics.correlation_matrix(readings, columns),
        "diurnal_pattern": profiles.diurnal_pattern(measurements, sensors),
        "seasonal_pattern": profiles.seasonal_pattern(measurements, sensors),
        "city_ranking": profiles.city_ranking(measurements, sensors).withColumnRenamed(
            "pm25_raw", "avg_pm25"
        ),
    }
    for name, report in reports.items():
        write_report(report, report_root, name)


def index(spark: SparkSession, root: str) -> DataFrame:
    """-> `aqi`, `daily_city_aqi`. Returns the cross-check against the exported indexes."""
    measurements, sensors = _fact(spark, root)
    write_measurements(air_quality.reading_aqi(measurements, sensors), root, "aqi")
    write_table(air_quality.daily_city_aqi(read_table(spark, root, "aqi")), root, "daily_city_aqi")
    return air_quality.cross_checks(measurements, sensors)


def train(spark: SparkSession, root: str, model_root: str) -> list[training.TargetRun]:
    """-> `ml_metrics`, `ml_predictions`, and the best model of each target."""
    runs = training.run_targets(*_fact(spark, root))
    write_table(training.all_metrics(runs), root, "ml_metrics")
    write_table(training.all_predictions(runs), root, "ml_predictions")
    for run in runs:
        run.save_model(f"{model_root.rstrip('/')}/{run.target}")
    return runs


def find_anomalies(spark: SparkSession, root: str) -> None:
    """`daily_city_avg` -> `anomalies`."""
    daily = read_table(spark, root, "daily_city_avg")
    write_table(anomalies.detect_anomalies(daily), root, "anomalies")


# The tables that the jobs make.
TABLES = (
    "measurements", "sensors", "daily_city_avg", "monthly_city_avg", "aqi",
    "daily_city_aqi", "ml_metrics", "ml_predictions", "anomalies",
)


def available_tables(spark: SparkSession, root: str) -> list[str]:
    """Which of the nine tables exist already."""
    return [name for name in TABLES if table_exists(spark, root, name)]


def drop_old(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Remove older versions of all tables, and what killed jobs left. Returns the number of folders removed."""
    return sum(drop_old_versions(spark, root, name, keep) for name in (*TABLES, rollups.STATE))
