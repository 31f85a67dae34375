"""spark.ml pipelines of the candidate models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.operators.quantiles import exact_quantiles

RIDGE_ALPHA = 1.0
SEED = 42
# Depth of the forest's trees unless asked otherwise: a tree has at most 2**DEPTH leaves, however many rows there are, so
# the model stays a size that the driver can hold.
DEPTH = 12
# Boosting stops when the error on the rows held out, chosen by hash of their key, has stopped falling.
HELD_OUT, TOLERANCE = 0.1, 1e-4
HOLD = "__held_out__"
KEY = ("device_id", "timestamp")


def fill_values(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of each feature on the training rows; features without any value are left out."""
    rows = exact_quantiles(train, features, [0.5]).collect()
    medians = {row.column: row.value for row in rows}
    return {name: medians[name] for name in features if name in medians}


def imputer(fills: dict[str, float], flag_missing: bool = False) -> SQLTransformer:
    """Stage that fills missing features, and optionally adds a 0/1 column saying where."""
    parts = [f"coalesce(CAST(`{c}` AS DOUBLE), {v!r}D) AS `{c}_filled`" for c, v in fills.items()]
    if flag_missing:
        parts += [f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}_missing`" for c in fills]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _assembler(fills: dict[str, float], output: str, flag_missing: bool = False) -> VectorAssembler:
    inputs = [f"{c}_filled" for c in fills]
    if flag_missing:
        inputs += [f"{c}_missing" for c in fills]
    return VectorAssembler(inputCols=inputs, outputCol=output)


def scaled_features(fills: dict[str, float]) -> list:
    """Impute, assemble and standardise."""
    scaler = StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True)
    return [imputer(fills), _assembler(fills, "assembled"), scaler]


def ridge(train: DataFrame, fills: dict[str, float], alpha: float = RIDGE_ALPHA) -> PipelineModel:
    """Least squares plus alpha * |w|^2 on standardised features.

    Spark minimises the mean squared error on a label divided by its standard deviation, and its
    scaler divides by the sample deviation; the penalty is converted accordingly.
    """
    n, spread = train.agg(F.count("target"), F.stddev_pop("target")).first()
    penalty = alpha * ((n - 1) / n) * (spread or 0.0) / n
    regression = LinearRegression(
        featuresCol="features",
        labelCol="target",
        elasticNetParam=0.0,
        regParam=penalty,
        standardization=False,
        solver="normal",
    )
    return Pipeline(stages=[*scaled_features(fills), regression]).fit(train)


def random_forest(
    train: DataFrame, fills: dict[str, float], trees: int = 100, min_leaf: int = 5, depth: int = DEPTH
) -> PipelineModel:
    """Bagged trees over all features, grown to `depth` levels or leaves of `min_leaf` rows.

    Spark grows trees to 30 levels at most; trees that deep grow with the data and are assembled on the driver.
    """
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="target",
        numTrees=trees,
        minInstancesPerNode=min_leaf,
        maxDepth=depth,
        featureSubsetStrategy="all",
        cacheNodeIds=True,
        checkpointInterval=10,
        maxMemoryInMB=512,
        seed=SEED,
    )
    return Pipeline(stages=[imputer(fills), _assembler(fills, "features"), forest]).fit(train)


def boosted_trees(
    train: DataFrame, fills: dict[str, float], rounds: int = 300, rate: float = 0.1, key: Sequence[str] = KEY
) -> PipelineModel:
    """Gradient boosting on binned features, about 31 leaves of at least 20 rows per tree.

    Missing values are filled and flagged, so that trees can split on absence. A tenth of the rows, by hash of `key`, is
    held out: trees are added while they lower the error there, `rounds` at most. The same rows are held out every time.
    """
    held_out = F.pmod(F.xxhash64(*key, F.lit(SEED)), F.lit(1000)) < int(1000 * HELD_OUT)
    train = train.withColumn(HOLD, held_out)
    boosting = GBTRegressor(
        featuresCol="features",
        labelCol="target",
        maxIter=rounds,
        stepSize=rate,
        maxDepth=5,
        maxBins=255,
        minInstancesPerNode=20,
        checkpointInterval=10,
        validationIndicatorCol=HOLD,
        validationTol=TOLERANCE,
        seed=SEED,
    )
    stages = [imputer(fills, flag_missing=True), _assembler(fills, "features", flag_missing=True)]
    return Pipeline(stages=[*stages, boosting]).fit(train)
