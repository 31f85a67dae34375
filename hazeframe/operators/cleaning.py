"""Removal of unusable and duplicate readings and of empty columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.schema import METADATA

KEY = ("device_id", "timestamp")


def drop_unusable(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Readings that lack a key column cannot be used."""
    return df.na.drop(subset=list(key))


def completeness(columns: Sequence[str]) -> Column:
    """Number of filled cells of a row."""
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in columns])


def deduplicate(
    df: DataFrame, key: Sequence[str] = KEY, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One reading per key: the most complete one.

    Equal completeness is settled by `tie_break` (default: dataset, file, then a hash of the row), so
    the result does not depend on the order of the input. The rank filter reaches Spark as a window group limit, which
    keeps one row per key and task *before* the shuffle; a key that repeats a billion times
    sends one row per map task.
    """
    columns = df.columns
    if tie_break is None:
        order = [c for c in ("source_dataset", "source_file") if c in columns]
        ties = [*[F.col(c) for c in order], F.xxhash64(*columns)]
    else:
        ties = [F.col(c) for c in tie_break]
    # Sorting by a hash of the key first makes almost every comparison one of two longs.
    best_first = Window.partitionBy(F.xxhash64(*key), *key).orderBy(completeness(columns).desc(), *ties)
    return df.withColumn("_rank", F.row_number().over(best_first)).where("_rank = 1").drop("_rank")


def filled_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_filled, missing_pct) for every column, in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n")) for i, c in enumerate(columns)]
    )
    share = (F.col("n_rows") - F.col("cell.n")) * F.lit(100.0) / F.nullif("n_rows", F.lit(0))
    return counts.select("n_rows", F.explode(cells).alias("cell")).select(
        F.col("cell.column").alias("column"),
        "n_rows",
        F.col("cell.n").alias("n_filled"),
        share.alias("missing_pct"),
    )


def empty_columns(df: DataFrame, essential: Sequence[str] = METADATA) -> list[str]:
    """Columns without a single value. Runs one small aggregate: the schema depends on its answer."""
    candidates = [c for c in df.columns if c not in essential]
    if not candidates:
        return []
    found = filled_counts(df, candidates).where("n_filled = 0").select("column").collect()
    names = {row.column for row in found}
    return [c for c in candidates if c in names]


def drop_empty_columns(df: DataFrame, essential: Sequence[str] = METADATA) -> DataFrame:
    return df.drop(*empty_columns(df, essential))


def stage_counts(raw: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row: readings in, unusable, duplicate, kept.

    Distinct keys are counted by aggregating per key first, so nothing but per-key counts is shuffled.
    """
    usable = F.lit(True)
    for c in key:
        usable = usable & F.col(c).isNotNull()
    per_key = raw.select(*key, usable.alias("usable")).groupBy(*key, "usable").agg(
        F.count(F.lit(1)).alias("n")
    )
    kept = F.count_if("usable")
    n_usable = F.coalesce(F.sum(F.when(F.col("usable"), F.col("n"))), F.lit(0))
    n_unusable = F.coalesce(F.sum(F.when(~F.col("usable"), F.col("n"))), F.lit(0))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_read"),
        n_unusable.alias("n_unusable"),
        (n_usable - kept).alias("n_duplicates"),
        kept.alias("n_kept"),
    )
