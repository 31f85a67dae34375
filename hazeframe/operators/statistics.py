"""Descriptive statistics, distributions and correlations over measurement columns."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions.numeric import TINY, bias_corrected, pearson, ratio, to_number
from hazeframe.operators.cleaning import filled_counts
from hazeframe.operators.quantiles import cells, column_at, exact_quantiles, quantile_table

# Task functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUARTILES = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
# Relative size below which a difference of sums is taken for rounding error.
ROUNDING = 1e-11


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict[str, str]) -> DataFrame:
    """(column, position, statistics...): SQL aggregates over `@`, for every column in one pass."""
    rows = []
    for i, c in enumerate(columns):
        # The same meaning of missing as elsewhere: unreadable cells and NaN are NULL.
        cells_of = [F.expr(sql.replace("@", f"v{i}")).alias(name) for name, sql in stats.items()]
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), *cells_of))
    numbers = df.select(*(to_number(F.col(f"`{c.replace('`', '``')}`")).alias(f"v{i}") for i, c in enumerate(columns)))
    return numbers.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


SHAPE = {
    "n_rows": "count(1)",
    "count": "count(@)",
    "mean": "avg(@)",
    "std": "stddev_samp(@)",
    "min": "min(@)",
    "max": "max(@)",
    "population_skew": f"skewness(CASE WHEN abs(@) < {TINY!r} THEN 0D ELSE @ END)",
}
SKEW = ("population_skew", "count", "min", "max")


def descriptive_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, count, mean, std, min, q25, q50, q75, max, missing_pct, skew: one row per column."""
    moments = _per_column(df, columns, SHAPE)
    quartiles = quantile_table(exact_quantiles(df, columns, list(QUARTILES)), QUARTILES)
    missing = ratio((F.col("n_rows") - F.col("count")) * F.lit(100.0), F.col("n_rows").cast("double"))
    # Both sides hold one row per measurement column.
    return (
        moments.join(F.broadcast(quartiles), "column", "left")
        .orderBy("position")
        .select(
            "column", "count", "mean", "std", "min", *QUARTILES.values(), "max",
            missing.alias("missing_pct"), bias_corrected(*map(F.col, SKEW)).alias("skew"),
        )
    )


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, missing_pct), emptiest first."""
    return filled_counts(df, columns).select("column", "missing_pct").orderBy(
        F.col("missing_pct").desc(), "column"
    )


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, skew), largest absolute skew first."""
    table = _per_column(df, columns, {name: SHAPE[name] for name in SKEW})
    skew = table.select("column", "position", bias_corrected(*map(F.col, SKEW)).alias("skew"))
    return skew.orderBy(F.abs("skew").desc_nulls_last(), "position").select("column", "skew")


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, outlier_pct): share of present values strictly beyond 1.5 IQR, largest first."""
    quartiles = quantile_table(exact_quantiles(df, columns, (0.25, 0.75)), {0.25: "q1", 0.75: "q3"})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    order = F.array(*[F.lit(c) for c in columns])
    fences = quartiles.select(
        (F.array_position(order, F.col("column")) - 1).cast("int").alias("position"),
        (F.col("q1") - reach).alias("low"),
        (F.col("q3") + reach).alias("high"),
    )
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    shares = (
        cells(df, columns)
        .join(F.broadcast(fences), "position")
        .groupBy("position")
        .agg((F.count_if(outside) * 100.0 / F.count(F.lit(1))).alias("outlier_pct"))
    )
    positions = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("position"))
    return (
        positions.join(F.broadcast(shares), "position", "left")
        .orderBy(F.col("outlier_pct").desc_nulls_last(), "position")
        .select(column_at(columns).alias("column"), "outlier_pct")
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """(column, bin, left, right, n, mean) with equal-width bins between minimum and maximum.

    Every bin is half-open but the last, which is closed; empty bins are listed. A constant column gets the
    range value +- 0.5. Two scans: limits, then counts combined before the shuffle.
    """
    flat = F.col("low") == F.col("high")
    limits = (
        _per_column(df, columns, {"low": "min(@)", "high": "max(@)", "mean": "avg(@)"})
        .where(F.col("low").isNotNull())
        .select(
            "position",
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
            "mean",
        )
        .withColumn("width", (F.col("high") - F.col("low")) / F.lit(float(bins)))
    )

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("high")).otherwise(F.col("low") + i * F.col("width"))

    place = F.floor((F.col("value") - F.col("low")) / F.nullif("width", F.lit(0.0)))
    guess = F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int")
    # Division may land one bin off; the edges decide.
    exact = (
        F.when(F.col("value") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("guess") < bins - 1) & (F.col("value") >= edge(F.col("guess") + 1)), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counts = (
        cells(df, columns)
        .join(F.broadcast(limits), "position")
        .withColumn("guess", guess)
        .groupBy("position", exact.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    slots = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return (
        slots.join(F.broadcast(counts), ["position", "bin"], "left")
        .orderBy("position", "bin")
        .select(
            column_at(columns).alias("column"),
            "bin",
            edge(F.col("bin")).alias("left"),
            edge(F.col("bin") + 1).alias("right"),
            F.coalesce("n", F.lit(0)).alias("n"),
            "mean",
        )
    )


def _pair_sums(width: int):
    """Task: sums over the rows where both columns of a pair are present, for all pairs at once."""
    first, second = np.triu_indices(width, 1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3 * width, 3 * width))
        for frame in frames:
            values = frame.to_numpy(dtype=float, na_value=np.nan)
            present = ~np.isnan(values)
            filled = np.where(present, values, 0.0)
            stacked = np.hstack([filled, present, filled * filled])
            total += stacked.T @ stacked
        v, m, s = (slice(i * width, (i + 1) * width) for i in range(3))
        yield pd.DataFrame(
            {
                "pos_a": first,
                "pos_b": second,
                "n": total[m, m][first, second],
                "sum_a": total[v, m][first, second],
                "sum_b": total[m, v][first, second],
                "sum_aa": total[s, m][first, second],
                "sum_bb": total[m, s][first, second],
                "sum_ab": total[v, v][first, second],
            }
        )

    return run


def _limits(df: DataFrame, columns: Sequence[str]) -> Column:
    """Centre (c0, c1, ...), minimum (low0, ...) and maximum (high0, ...) of the columns as one scalar: Spark computes it
    once for all places of a plan that use it."""
    parts = []
    for i, c in enumerate(columns):
        low, high = F.min(c), F.max(c)
        centre = F.when(low == high, low).otherwise(F.avg(c))
        parts += [centre.alias(f"c{i}"), low.alias(f"low{i}"), high.alias(f"high{i}")]
    return df.agg(F.struct(*parts)).scalar()


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(pos_a, pos_b, col_a, col_b, corr) of the upper triangle, pairwise-complete.

    Hundreds of pairwise aggregates are too many for generated code, so each Arrow batch is reduced to the
    sums of all pairs by one matrix product; a task hands on one row per pair. Columns are centred first,
    which keeps the sums well conditioned and makes a constant column exactly zero.
    """
    centre = _limits(df, columns)
    centred = df.select(*[(F.col(c) - centre.getField(f"c{i}")).alias(f"c{i}") for i, c in enumerate(columns)])
    names = ("n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab")
    schema = "pos_a int, pos_b int, " + ", ".join(f"{name} double" for name in names)
    sums = (
        centred.mapInPandas(_pair_sums(len(columns)), schema)
        .groupBy("pos_a", "pos_b")
        .agg(*[F.sum(name).alias(name) for name in names])
    )
    n = F.nullif("n", F.lit(0.0))

    def spread(total: str, squares: str) -> Column:
        shift = F.col(total) * F.col(total) / n
        # Within rounding of zero: constant wherever the other column is present.
        return F.when(F.col(squares) - shift > shift * ROUNDING, F.col(squares) - shift)

    shared = F.col("sum_ab") - F.col("sum_a") * F.col("sum_b") / n
    scale = F.sqrt(spread("sum_a", "sum_aa")) * F.sqrt(spread("sum_b", "sum_bb"))
    corr = shared / F.nullif(scale, F.lit(0.0))
    label = F.array(*[F.lit(c) for c in columns])
    return sums.select(
        "pos_a",
        "pos_b",
        F.element_at(label, F.col("pos_a") + 1).alias("col_a"),
        F.element_at(label, F.col("pos_b") + 1).alias("col_b"),
        F.when(F.abs(corr) > 1, F.signum(corr)).otherwise(corr).alias("corr"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col_a, col_b, corr) for every ordered pair; the diagonal is 1, or NULL for constant columns."""
    upper = correlation_pairs(df, columns)
    fields = ("pos_a", "pos_b", "col_a", "col_b", "corr")
    mirrored = upper.select(
        *[F.col(c).alias(f) for c, f in zip(("pos_b", "pos_a", "col_b", "col_a", "corr"), fields)]
    )
    limits = _limits(df, columns)
    rows = []
    for i, c in enumerate(columns):
        varies = F.when(limits.getField(f"low{i}") < limits.getField(f"high{i}"), F.lit(1.0))
        values = (F.lit(i), F.lit(i), F.lit(c), F.lit(c), varies)
        rows.append(F.struct(*[value.alias(f) for value, f in zip(values, fields)]))
    diagonal = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    whole = upper.unionByName(mirrored).unionByName(diagonal)
    return whole.orderBy("pos_a", "pos_b").select("col_a", "col_b", "corr")


def strongest_pair(pairs: DataFrame) -> DataFrame:
    """The pair with the largest absolute correlation; the first pair in column order wins ties."""
    known = pairs.where(F.col("corr").isNotNull())
    return known.orderBy(F.abs("corr").desc(), "pos_a", "pos_b").limit(1).select("col_a", "col_b", "corr")


def target_correlations(matrix: DataFrame, target: str) -> DataFrame:
    """Other columns by signed correlation with the target, strongest positive first."""
    others = matrix.where((F.col("col_a") == target) & (F.col("col_b") != target))
    return others.orderBy(F.col("corr").desc_nulls_last(), "col_b").select(
        F.col("col_b").alias("column"), "corr"
    )


def best_partner(matrix: DataFrame, targets: Sequence[str]) -> DataFrame:
    """For each target, the other column with the largest absolute correlation."""
    others = matrix.where(
        F.col("col_a").isin(*targets) & (F.col("col_a") != F.col("col_b")) & F.col("corr").isNotNull()
    )
    strongest_first = Window.partitionBy("col_a").orderBy(F.abs("corr").desc(), "col_b")
    return (
        others.withColumn("rank", F.row_number().over(strongest_first))
        .where("rank = 1")
        .select(F.col("col_a").alias("target"), F.col("col_b").alias("column"), "corr")
    )


def paired_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation, strength band and least-squares line of y on x over rows that have both."""
    in_pair_x = F.when(F.col(y).isNotNull(), F.col(x))
    fit = df.agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        pearson(x, y).alias("corr"),
        ratio(F.covar_pop(x, y), F.var_pop(in_pair_x)).alias("slope"),
        F.avg(in_pair_x).alias("mean_x"),
        F.avg(F.when(F.col(x).isNotNull(), F.col(y))).alias("mean_y"),
        F.min(in_pair_x).alias("min_x"),
        F.max(in_pair_x).alias("max_x"),
    )
    size = F.abs("corr")
    strength = F.when(size > 0.5, "strong").when(size > 0.3, "moderate").otherwise("weak")
    return fit.select(
        "n",
        "corr",
        strength.alias("strength"),
        "slope",
        (F.col("mean_y") - F.col("slope") * F.col("mean_x")).alias("intercept"),
        "min_x",
        "max_x",
    )


def fit_line(fit: DataFrame, points: int = 50) -> DataFrame:
    """Evenly spaced points (i, x, y) of a fitted line from the smallest to the largest x."""
    i = F.col("i")
    step = (F.col("max_x") - F.col("min_x")) / F.lit(float(points - 1))
    x = F.when(i == points - 1, F.col("max_x")).otherwise(F.col("min_x") + i * step)
    return (
        fit.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .select("i", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))
    )


def impossible_values(df: DataFrame, smaller: str = "pm25_raw", larger: str = "pm10_raw") -> DataFrame:
    """Rows in which the coarser fraction is below the finer one: count, and percent of all rows."""
    bad = F.count_if(F.col(larger) < F.col(smaller))
    total = F.count(F.lit(1))
    return df.agg(
        bad.alias("n_bad"),
        total.alias("n_rows"),
        ratio(bad * F.lit(100.0), total.cast("double")).alias("bad_pct"),
    )


def sampled_pairs(df: DataFrame, x: str, y: str, key: Sequence[str], size: int = 5000, seed: int = 42) -> DataFrame:
    """Seeded sample of at most `size` rows that have both columns: those with the smallest MD5 of seed and key.

    The cut-off is found from counts per hash prefix, so the final sort sees little more than `size` rows
    instead of `size` rows from every task.
    """
    pairs = df.select(*key, x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    hashed = pairs.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in key))))
    prefix = F.substring("_hash", 1, 5)
    per_prefix = hashed.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    # At most 2^20 rows, however many pairs there are.
    running = per_prefix.withColumn("upto", F.sum("n").over(Window.orderBy("prefix")))
    enough = F.min(F.when(F.col("upto") >= size, F.col("prefix")))
    cut = running.agg(F.coalesce(enough, F.max("prefix")).alias("cut"))
    return (
        hashed.where(prefix <= cut.scalar())
        .orderBy("_hash", *key)
        .limit(size)
        .select(*key, x, y)
    )
