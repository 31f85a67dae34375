"""Training, comparison and prediction for all targets."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.learning.dataset import (
    build_dataset,
    evaluate,
    feature_columns,
    split_point,
    time_split,
)
from hazeframe.learning.models import boosted_trees, fill_values, random_forest, ridge, scaled_features
from hazeframe.learning.network import NetworkModel, fit_network
from hazeframe.session import cut_lineage
from hazeframe.sources.tables import table_exists
from hazeframe.sources.versions import Writing, current

TARGETS = ("pm25_raw", "pm10_raw")
BASELINE = "Persistence (baseline)"
METRICS_SCHEMA = "target string, model string, mae double, rmse double, r2 double, train_seconds double"
#: Rows of a training task: at least, up to as many tasks as the cluster runs at once, and at most.
LEAST_ROWS, MOST_ROWS = 4096, 250_000

Trainer = Callable[[DataFrame, dict[str, float]], object]


def network(train: DataFrame, fills: dict[str, float]) -> NetworkModel:
    preparation = Pipeline(stages=scaled_features(fills)).fit(train)
    return fit_network(train, preparation, ["device_id", "timestamp"])


# The model names of the comparison table.
TRAINERS: dict[str, Trainer] = {
    "Ridge": ridge,
    "RandomForest": random_forest,
    "HistGradientBoosting": boosted_trees,
    "MLP": network,
}


@dataclass
class TargetRun:
    """Result of one target."""

    target: str
    metrics: DataFrame
    predictions: DataFrame
    best_name: str
    best_model: object

    def save_model(self, path: str) -> None:
        """A new version of the model folder; readers get the old one until it is complete."""
        writing = Writing(self.metrics.sparkSession, path)
        where = f"{writing.path}/{writing.folder}"
        if isinstance(self.best_model, NetworkModel):
            self.best_model.save(where)
        else:
            self.best_model.write().save(where)
        writing.commit([writing.folder], facts={"model": self.best_name})


def load_model(spark: SparkSession, path: str) -> NetworkModel | PipelineModel:
    """A saved best model of either kind: the newest version, or a plain model folder."""
    version = current(spark, path.rstrip("/"))
    where = f"{version.path}/{version.folders[0]}" if version else path
    return NetworkModel.load(where) if table_exists(spark, where, "parameters") else PipelineModel.load(where)


def side_by_side(spark: SparkSession, task: Callable, items: Sequence) -> list:
    """Run driver-side tasks in threads. Boosting is a long chain of small jobs that leaves executors
    idle; the jobs of other models fill them."""
    with ThreadPool(max(1, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items)


def training_tasks(rows: int, at_once: int) -> int:
    """Tasks that so many rows are trained in, on a cluster that runs `at_once`."""
    return max(1, min(-(-rows // LEAST_ROWS), at_once), -(-rows // MOST_ROWS))


def by_rows(dataset: DataFrame) -> DataFrame:
    """A stored data set in as many partitions as its rows need, which keeps each row's neighbours.

    In each of the many jobs of a training a task of trees fills, and sends, sums of all bins of the nodes at hand, however few rows
    it has. Hours of a fleet are few beside its readings, so partitions by the size of these would multiply that work.
    """
    return dataset.coalesce(training_tasks(dataset.count(), dataset.sparkSession.sparkContext.defaultParallelism))


def persistence(test: DataFrame, target_column: str) -> DataFrame:
    """Baseline: the next hour equals the current one."""
    return test.withColumn("prediction", F.col(target_column))


def predictions_table(scored: DataFrame, target_column: str, model: str) -> DataFrame:
    """`ml_predictions` rows. The timestamp is the hour the forecast was made, not the hour forecast."""
    return scored.select(
        "device_id",
        "city",
        "timestamp",
        F.col("target").alias("actual"),
        F.col("prediction").alias("predicted"),
        F.lit(target_column).alias("target"),
        F.lit(model).alias("model"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The trained model with the smallest mean absolute error, baseline excluded."""
    return metrics.where(F.col("model") != BASELINE).orderBy("mae", "model").limit(1)


def run_target(
    measurements: DataFrame,
    sensors: DataFrame,
    target_column: str,
    trainers: dict[str, Trainer] | None = None,
    horizon: int = 1,
    together: bool = False,
) -> TargetRun:
    """Train every candidate on the first 80 % of the time and score it on the rest.

    One after the other, so that their training seconds compare; `together` trains them side by side, which is sooner done
    but times each of them under the load of the others.
    """
    trainers = TRAINERS if trainers is None else trainers
    spark = measurements.sparkSession
    dataset = by_rows(cut_lineage(build_dataset(measurements, sensors, target_column, horizon)))
    # As microseconds: a timestamp on the driver would pass through the zone of its operating system.
    micros = split_point(dataset).select(F.unix_micros("split_ts").alias("at")).first()["at"]
    train, test = time_split(dataset, split_ts=F.timestamp_micros(F.lit(micros)))
    fills = fill_values(train, feature_columns(dataset))

    def score(scored: DataFrame) -> tuple:
        return tuple(evaluate(scored, "target", "prediction").first())

    def fit(name: str) -> tuple[object, tuple]:
        started = time.perf_counter()
        model = trainers[name](train, fills)
        seconds = round(time.perf_counter() - started, 1)
        return model, (target_column, name, *score(model.transform(test)), seconds)

    results = side_by_side(spark, fit, list(trainers)) if together else [fit(name) for name in trainers]
    fitted = {name: model for name, (model, _) in zip(trainers, results)}
    baseline = (target_column, BASELINE, *score(persistence(test, target_column)), 0.0)
    rows = [baseline, *(row for _, row in results)]
    metrics = spark.createDataFrame(rows, METRICS_SCHEMA)
    best = best_model(metrics).first().model
    predictions = predictions_table(fitted[best].transform(test), target_column, best)
    return TargetRun(target_column, metrics, predictions, best, fitted[best])


def run_targets(
    measurements: DataFrame,
    sensors: DataFrame,
    targets: Sequence[str] = TARGETS,
    trainers: dict[str, Trainer] | None = None,
    together: bool = False,
) -> list[TargetRun]:
    """All targets; with `together`, they and their models are trained side by side."""

    def run(target: str) -> TargetRun:
        return run_target(measurements, sensors, target, trainers, together=together)

    return side_by_side(measurements.sparkSession, run, targets) if together else [run(target) for target in targets]


def all_metrics(runs: Sequence[TargetRun]) -> DataFrame:
    """`ml_metrics` table."""
    return reduce(DataFrame.unionByName, [run.metrics for run in runs])


def all_predictions(runs: Sequence[TargetRun]) -> DataFrame:
    """`ml_predictions` table."""
    return reduce(DataFrame.unionByName, [run.predictions for run in runs])
