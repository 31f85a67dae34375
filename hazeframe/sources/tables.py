"""Versioned Parquet tables under one root folder, and CSV reports.

Replacing a table writes a new version beside the old one and then switches to it (`versions`), so that readers and jobs that
fail half-way never meet a table without its data.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.sources import versions
from hazeframe.sources.versions import DATA, VERSION, Version, Writing

# First day of the UTC month of a reading; partitions the fact table.
MONTH = "utc_month"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def table_version(spark: SparkSession, root: str, name: str) -> Version | None:
    """The version that readers get; None if the table was never written, or is a plain folder of files."""
    return versions.current(spark, table_path(root, name))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of a table, or the files of a plain folder."""
    version = table_version(spark, root, name)
    return version.read(spark) if version else spark.read.parquet(table_path(root, name))


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a table can be read, asked without starting a job on its rows."""
    if table_version(spark, root, name):
        return True
    try:
        spark.read.parquet(table_path(root, name))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def write_table(df: DataFrame, root: str, name: str, facts: Mapping | None = None) -> Version:
    """Replace a table. `df` may read the table's present version."""
    writing = Writing(df.sparkSession, table_path(root, name))
    df.write.parquet(f"{writing.path}/{writing.folder}")
    return writing.commit([writing.folder], df.schema, dict(facts or {}))


def month_of(folder: str) -> str:
    """The month that a folder of a monthly table holds, as yyyy-MM-dd."""
    return folder.split(f"{MONTH}=", 1)[1].split("/", 1)[0]


def write_months(writing: Writing, df: DataFrame) -> dict[str, str]:
    """Write rows with a `utc_month` as part of a version. Returns the folder of each month that has rows.

    REBALANCE lets AQE split a month (or a device within it) that outgrows one task and merge small
    ones, so file sizes stay even whatever the skew. Rows are sorted inside each file, which
    gives tight row-group bounds on device and time.
    """
    order = [c for c in (MONTH, "device_id", "timestamp", "date", "hour") if c in df.columns]
    (
        df.withColumn(VERSION, F.lit(writing.token))
        .hint("rebalance", MONTH)
        .sortWithinPartitions(*order)
        .write.mode("append")
        .partitionBy(MONTH, VERSION)
        .parquet(f"{writing.path}/{DATA}")
    )
    found = versions.matching(writing.spark, f"{writing.path}/{DATA}/{MONTH}=*/{VERSION}={writing.token}")
    return {month_of(path): path[path.rindex(f"{DATA}/{MONTH}=") :] for path in found}


def with_month(df: DataFrame) -> DataFrame:
    """Rows with the first day of their UTC month."""
    return df.withColumn(MONTH, F.trunc(F.to_date("timestamp"), "month"))


def write_measurements(
    df: DataFrame, root: str, name: str = "measurements", months: Collection[str] | None = None, facts: Mapping | None = None
) -> Version:
    """Replace the fact table, or one with a row for each of its readings, one folder per UTC month.

    With `months` (first days, yyyy-MM-dd) only those are replaced: `df` holds all their rows, and the other months keep their folders.
    """
    df = with_month(df)
    writing = Writing(df.sparkSession, table_path(root, name))
    folders = {month_of(f): f for f in writing.before.folders} if months is not None and writing.before else {}
    folders = {month: folder for month, folder in folders.items() if month not in set(months or ())}
    folders |= write_months(writing, df)
    return writing.commit([folders[month] for month in sorted(folders)], df.schema, dict(facts or {}))


def drop_old_versions(spark: SparkSession, root: str, name: str, keep: int = 1) -> int:
    """Remove older versions of a table and what killed jobs left of it. Returns the number of folders removed."""
    return versions.drop_old(spark, table_path(root, name), keep)


def write_report(df: DataFrame, root: str, name: str) -> None:
    """Replace a CSV report. Reports are aggregates of a few hundred rows, so one file is enough."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(table_path(root, name))
