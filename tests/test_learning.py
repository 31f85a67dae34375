"""Features, split, models, training."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from hazeframe import fixtures as fx
from hazeframe.learning import dataset as ds
from hazeframe.learning import models, network, training
from hazeframe.session import cut_lineage

T0 = dt.datetime(2022, 3, 1)


@pytest.fixture(scope="module")
def data(spark, medium):
    return cut_lineage(ds.build_dataset(fx.readings(spark, medium), fx.sensors(spark, medium), "pm25_raw"))


@pytest.fixture(scope="module")
def parts(data):
    return ds.time_split(data)


def test_features(data):
    features = ds.feature_columns(data)
    assert len(features) == 22 and features[0] == "pm25_raw" and features[-1] == "is_heating_season"
    assert data.columns[:3] == ["timestamp", "device_id", "city"] and data.columns[-1] == "target"


def test_horizon(spark):
    rows = [("A", T0 + dt.timedelta(hours=h), float(h), None, None, None) for h in range(10)]
    schema = "device_id string, timestamp timestamp, pm25_raw double, no2_raw double, temp_internal double, humidity_internal double"
    sensors = spark.createDataFrame([("A", "x")], "device_id string, city string")
    got = ds.build_dataset(spark.createDataFrame(rows, schema), sensors, "pm25_raw", horizon=3)
    pairs = {(r.pm25_raw, r.target, r.lag_2h) for r in got.collect()}
    assert pairs == {(1.0, 4.0, None), *((float(h), h + 3.0, h - 2.0) for h in range(2, 7))}


def test_split_leaks_nothing(data, parts):
    train, test = parts
    at = ds.split_point(data).first().split_ts
    last, first = train.agg(F.max("timestamp")).first()[0], test.agg(F.min("timestamp")).first()[0]
    assert last <= at < first
    assert train.count() + test.count() == data.count()


def test_evaluation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 4.0), (None, 9.0)], "y double, p double")
    row = ds.evaluate(df, "y", "p").first()
    assert (row.mae, row.rmse, row.r2) == pytest.approx((1.0, (5 / 3) ** 0.5, 1 - 5 / 14))
    assert ds.evaluate(df.limit(1), "y", "p").first().r2 is None


def test_medians_and_absent_features(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (5.0, None), (9.0, None), (None, None)], "a double, b double")
    fills = models.fill_values(df, ["a", "b"])
    assert fills == {"a": 3.5}
    got = models.imputer(fills, flag_missing=True).transform(df).select("a_filled", "a_missing").collect()
    assert [tuple(r) for r in got] == [(1.0, 0.0), (2.0, 0.0), (5.0, 0.0), (9.0, 0.0), (3.5, 1.0)]


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(3, 2, (80, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(0, 1, 80) + 7
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, target double")
    model = models.ridge(df, models.fill_values(df, ["a", "b", "c"]), alpha=25.0)
    z = (x - x.mean(0)) / x.std(0)
    weights = np.linalg.solve(z.T @ z + 25.0 * np.eye(3), z.T @ (y - y.mean()))
    got = [r.prediction for r in model.transform(df).select("prediction").collect()]
    np.testing.assert_allclose(got, z @ weights + y.mean(), atol=1e-9)


def test_boosting_stops_early(spark):
    df = cut_lineage(spark.range(1500).select("id", F.randn(1).alias("a")).withColumn("target", F.col("a") * 0 + F.randn(7)))
    model = models.boosted_trees(df, {"a": 0.0}, rounds=40, key=["id"])
    assert model.stages[-1].getNumTrees < 40
    again = models.boosted_trees(df, {"a": 0.0}, rounds=40, key=["id"])
    assert again.stages[-1].getNumTrees == model.stages[-1].getNumTrees


def test_forest_of_bounded_depth_is_as_good(parts):
    train, test = (cut_lineage(part) for part in parts)
    fills = models.fill_values(train, ds.feature_columns(train))

    def mae(depth):
        model = models.random_forest(train, fills, trees=10, depth=depth)
        return ds.evaluate(model.transform(test), "target", "prediction").first().mae

    assert mae(models.DEPTH) == pytest.approx(mae(30), rel=0.05)


def test_network_gradient():
    rng = np.random.default_rng(1)
    sizes = [3, 5, 4, 1]
    vector = network.initial_weights(sizes, 0)
    x, y = rng.normal(size=(7, 3)), rng.normal(size=7)

    def loss(v):
        error = network.forward(x, v, sizes)[-1][:, 0] - y
        penalty = sum((w**2).sum() for w, _ in network.layers_of(v, sizes))
        return (error @ error) / 14 + network.DECAY * penalty / 14

    got = network.gradient(x, y, vector, sizes)
    for i in rng.choice(len(vector), 20, replace=False):
        step = np.zeros_like(vector)
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(vector + step) - loss(vector - step)) / 2e-6, abs=1e-6)


def test_network_learns_across_tasks(spark, tmp_path):
    df = spark.range(8000).select(
        "id", (F.randn(1) * 2).alias("a"), F.randn(2).alias("b")
    ).withColumn("target", F.abs("a") * 3 + F.col("b"))
    df = cut_lineage(df)
    fills = models.fill_values(df, ["a", "b"])
    preparation = Pipeline(stages=models.scaled_features(fills)).fit(df)
    model = network.fit_network(df, preparation, ["id"], hidden=(32, 16), epochs=60)
    assert model.scores[0] < 0 < 0.9 < max(model.scores) and len(model.scores) <= 61
    before = ds.evaluate(model.transform(df), "target", "prediction").first()
    assert before.r2 > 0.9
    model.save(str(tmp_path / "net"))
    loaded = network.NetworkModel.load(str(tmp_path / "net"))
    assert ds.evaluate(loaded.transform(df), "target", "prediction").first().mae == pytest.approx(before.mae)


def test_network_depends_on_its_rows_alone(spark, monkeypatch):
    """One, four and eight tasks, other orders and other partitions give the same weights; sums of many blocks as well."""
    rows = spark.range(3000).select("id", (F.randn(1) * 2).alias("a"), F.randn(2).alias("b"))
    df = cut_lineage(rows.withColumn("target", F.abs("a") * 3 + F.col("b")))
    preparation = Pipeline(stages=models.scaled_features(models.fill_values(df, ["a", "b"]))).fit(df)
    monkeypatch.setattr(network, "BLOCK_ROWS", 100)

    def fitted(data, tasks):
        return network.fit_network(data, preparation, ["id"], hidden=(8,), epochs=12, tasks=tasks).weights

    one = fitted(df, 1)
    for data, tasks in ((df, 4), (df, 8), (df.orderBy("a").repartition(3), None)):
        np.testing.assert_allclose(fitted(data, tasks), one, rtol=0, atol=1e-9)


def test_sums_of_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    sums = rng.normal(size=(90, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(sums)], network.SUMS).repartition(7)
    monkeypatch.setattr(network, "FAN", 4)
    got = [network.total_of(df.repartition(n), 90) for n in (1, 3, 8)]
    np.testing.assert_allclose(got[0], sums.sum(axis=0), atol=1e-12)
    assert (got[0] == got[1]).all() and (got[0] == got[2]).all()


def test_run_target(spark, medium, tmp_path):
    trainers = {
        "Ridge": models.ridge,
        "RandomForest": lambda train, fills: models.random_forest(train, fills, trees=5, depth=6),
        "HistGradientBoosting": lambda train, fills: models.boosted_trees(train, fills, rounds=3),
    }
    pair = fx.readings(spark, medium), fx.sensors(spark, medium)
    runs = training.run_targets(*pair, trainers=trainers, together=True)
    metrics = training.all_metrics(runs).toPandas()
    assert metrics.groupby("target")["model"].apply(list).to_dict() == {
        t: [training.BASELINE, *trainers] for t in training.TARGETS
    }
    assert np.isfinite(metrics[["mae", "rmse", "r2"]]).all(axis=None)
    assert (metrics["mae"] <= metrics["rmse"]).all() and (metrics["r2"] <= 1).all()
    assert metrics[metrics["model"] == training.BASELINE]["train_seconds"].eq(0).all()
    for run in runs:
        chosen = metrics[(metrics["target"] == run.target) & (metrics["model"] != training.BASELINE)]
        assert run.best_name == chosen.sort_values("mae").iloc[0]["model"]
    predictions = training.all_predictions(runs)
    assert predictions.where("predicted IS NULL OR actual IS NULL").count() == 0
    run = runs[0]
    run.save_model(str(tmp_path / "model"))
    run.save_model(str(tmp_path / "model"))
    _, test = ds.time_split(ds.build_dataset(*pair, run.target))
    again = training.load_model(spark, str(tmp_path / "model")).transform(test)
    want = predictions.where(F.col("target") == run.target).agg(F.sum("predicted")).first()[0]
    assert again.agg(F.sum("prediction")).first()[0] == pytest.approx(want)


def test_training_tasks_follow_the_rows(spark):
    """However many partitions a data set is made in, its models see as many as its rows need, and the same rows."""
    assert [training.training_tasks(n, 12) for n in (0, 1, 5000, 10**6, 10**7)] == [1, 1, 2, 12, 40]
    rng = np.random.default_rng(3)
    rows = [(d, T0 + dt.timedelta(hours=h), float(rng.normal(20, 5)), None, None, None) for d in "ABCDE" for h in range(150)]
    schema = "device_id string, timestamp timestamp, pm25_raw double, no2_raw double, temp_internal double, humidity_internal double"
    sensors = spark.createDataFrame([(d, "x") for d in "ABCDE"], "device_id string, city string")
    seen, before = [], spark.conf.get("spark.sql.shuffle.partitions")

    def trainer(train, fills):
        seen.append((train.rdd.getNumPartitions(), train.count()))
        return models.ridge(train, fills)

    try:
        scores = []
        for partitions in ("3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            run = training.run_target(spark.createDataFrame(rows, schema), sensors, "pm25_raw", {"Ridge": trainer})
            scores.append([(r.model, pytest.approx(r.mae), pytest.approx(r.rmse)) for r in run.metrics.collect()])
            assert run.predictions.count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [n for n, _ in seen] == [1, 1] and seen[0] == seen[1]
    assert [[c.expected if hasattr(c, "expected") else c for c in r] for r in scores[0]] == [list(r) for r in scores[1]]


def test_best_model_ignores_the_baseline(spark):
    rows = [("t", training.BASELINE, 0.1, 0.1, 1.0, 0.0), ("t", "Ridge", 2.0, 2.0, 0.5, 1.0), ("t", "MLP", 1.0, 2.0, 0.5, 1.0)]
    assert training.best_model(spark.createDataFrame(rows, training.METRICS_SCHEMA)).first().model == "MLP"
