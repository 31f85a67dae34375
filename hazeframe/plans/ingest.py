"""CSV folders -> `measurements`, reading only files that are new or have changed.

A version of the fact table carries a list of the files it was made from: their size and time of change, how many rows they
hold, how many of them are usable, and the months these fall in. Comparing it with the folders says what to read and which
months to write anew; the other months keep their folders. Rows and list become visible with one commit, so that counts are
those of the data, whatever tasks were run twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.operators import cleaning
from hazeframe.schema import MEASUREMENTS
from hazeframe.sources import exports, tables, versions
from hazeframe.sources.tables import MONTH, month_of

FACT = "measurements"
#: What the list says of a file.
LIST = f"{exports.FILES}, n_read long, n_usable long, months array<string>"
FILE = ["source_dataset", "source_file"]


def file_list(spark: SparkSession, root: str) -> DataFrame:
    """The files that the fact table was made from, with their counts and months."""
    version = tables.table_version(spark, root, FACT)
    if not version or not version.beside:
        return spark.createDataFrame([], LIST)
    return spark.read.schema(LIST).parquet(*(f"{version.path}/{folder}" for folder in version.beside))


def changes(spark: SparkSession, folders: Mapping[str, str], root: str) -> DataFrame:
    """The files of the folders and of the list, each with `state`: new, changed, gone or same.

    Columns are those of the listing and the list's `n_read`, `n_usable`, `months`; a file is known by dataset and name.
    """
    listed = [exports.list_files(spark, path, label) for label, path in folders.items()]
    found = reduce(DataFrame.unionByName, listed) if listed else spark.createDataFrame([], exports.FILES)
    known = file_list(spark, root).select(
        *FILE, F.col("size").alias("old_size"), F.col("modified").alias("old_modified"), "n_read", "n_usable", "months"
    )
    same = (F.col("size") == F.col("old_size")) & (F.col("modified") == F.col("old_modified"))
    state = (
        F.when(F.col("path").isNull(), "gone").when(F.col("old_size").isNull(), "new").when(same, "same").otherwise("changed")
    )
    return found.join(known, FILE, "full").withColumn("state", state).drop("old_size", "old_modified")


def parsed(spark: SparkSession, folders: Mapping[str, str], files: DataFrame, **csv_options: str) -> DataFrame:
    """The rows of `files` (source_dataset, path), standardised."""
    parts = []
    for row in files.select("source_dataset").distinct().orderBy("source_dataset").collect():
        own = files.where(F.col("source_dataset") == row.source_dataset)
        parts.append(exports.load_folder(spark, folders[row.source_dataset], row.source_dataset, own, **csv_options))
    return exports.append(exports.empty_measurements(spark), *parts)


def load(spark: SparkSession, folders: Mapping[str, str], root: str, **csv_options: str) -> DataFrame:
    """Bring the fact table up to date with CSV folders (label -> path). Returns the counts of each stage.

    The table holds what a load of all files into an empty root would give. Files are new or changed by size and time;
    those that are gone lose their rows. Duplicates are settled among the months' present rows and the new ones. Where a
    file's old content must go, the months it had rows in are made from all files that have rows in them, as a row that
    lost against a duplicate may come back. Data are parsed once, to a staged table; all counts are taken from files that
    were written.
    """
    where = tables.table_path(root, FACT)
    compared = changes(spark, folders, root).persist()
    try:
        states = {row.state: row.n for row in compared.groupBy("state").agg(F.count("*").alias("n")).collect()}
        version = tables.table_version(spark, root, FACT)
        if version and set(states) <= {"same"}:
            return counts(spark, root)
        # Months that a file no longer has, or has otherwise.
        old = compared.where("state IN ('gone', 'changed')").select(F.explode("months").alias(MONTH))
        undone = sorted(row[MONTH] for row in old.distinct().collect())
        again = F.arrays_overlap("months", F.array(*map(F.lit, undone)).cast("array<string>")) if undone else F.lit(False)
        to_read = compared.where(F.col("state").isin("new", "changed") | ((F.col("state") == "same") & again))
        staging = f"{where}/_staging/{uuid.uuid4()}"
        parsed(spark, folders, to_read, **csv_options).write.parquet(staging)
        staged = spark.read.schema(MEASUREMENTS).parquet(staging)
        listed = _listed(compared, staged)
        writing = versions.Writing(spark, where)
        beside = f"files/{versions.VERSION}={writing.token}"
        listed.write.parquet(f"{writing.path}/{beside}")
        # The months of new and changed files, as the written list has them.
        fresh = spark.read.schema(LIST).parquet(f"{writing.path}/{beside}").join(compared.where("state IN ('new', 'changed')").select(*FILE), FILE)
        added = [row[MONTH] for row in fresh.select(F.explode("months").alias(MONTH)).distinct().collect()]
        rewritten = sorted({*undone, *added})
        rows = _rows_of(spark, version, staged, undone, rewritten)
        folders_of = {month_of(f): f for f in (version.folders if version else ()) if month_of(f) not in rewritten}
        written = tables.write_months(writing, rows)
        facts = {m: n for m, n in (version.facts.get("rows", {}) if version else {}).items() if m in folders_of}
        facts |= _row_counts(spark, writing.path, written)
        folders_of |= written
        writing.commit([folders_of[m] for m in sorted(folders_of)], rows.schema, {"rows": facts}, [beside])
        versions.delete(spark, staging)
    finally:
        compared.unpersist()
    return counts(spark, root)


def _usable() -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cleaning.KEY])


def _listed(compared: DataFrame, staged: DataFrame) -> DataFrame:
    """The list of files that the new version has: counts of new and changed ones from the staged rows."""
    month = F.date_format(F.trunc(F.to_date("timestamp"), "month"), "yyyy-MM-dd")
    seen = staged.groupBy(*FILE).agg(
        F.count("*").alias("read"),
        F.count_if(_usable()).alias("usable"),
        F.array_sort(F.collect_set(F.when(_usable(), month))).alias("held"),
    )
    present = compared.where("state <> 'gone'").join(seen, FILE, "left")
    fresh = F.col("state") != "same"
    none = F.array().cast("array<string>")
    return present.select(
        *FILE, "path", "size", "modified",
        F.when(fresh, F.coalesce("read", F.lit(0))).otherwise(F.col("n_read")).alias("n_read"),
        F.when(fresh, F.coalesce("usable", F.lit(0))).otherwise(F.col("n_usable")).alias("n_usable"),
        F.when(fresh, F.coalesce("held", none)).otherwise(F.col("months")).alias("months"),
    )


def _rows_of(
    spark: SparkSession, version: versions.Version | None, staged: DataFrame, undone: list[str], rewritten: list[str]
) -> DataFrame:
    """All rows of the months to write: staged ones, and those that the table has of months that only gain rows."""
    wanted = F.col(MONTH).isin([F.lit(m).cast("date") for m in rewritten]) if rewritten else F.lit(False)
    rows = tables.with_month(cleaning.drop_unusable(staged)).where(wanted)
    stay = [f for f in (version.folders if version else ()) if month_of(f) in rewritten and month_of(f) not in undone]
    if stay:
        kept = versions.Version(version.path, version.number, tuple(stay), version.schema)
        rows = rows.unionByName(kept.read(spark))
    return tables.with_month(cleaning.deduplicate(rows.select(*MEASUREMENTS.names)))


def _row_counts(spark: SparkSession, path: str, folders: Mapping[str, str]) -> dict[str, int]:
    """Rows of each written month, from the files' footers."""
    if not folders:
        return {}
    read = spark.read.option("basePath", f"{path}/{versions.DATA}").parquet(*(f"{path}/{f}" for f in folders.values()))
    found = read.groupBy(MONTH).agg(F.count("*").alias("n")).collect()
    return {str(row[MONTH]): row.n for row in found}


def counts(spark: SparkSession, root: str) -> DataFrame:
    """One row: readings in, unusable, duplicate, kept, as committed with the table."""
    version = tables.table_version(spark, root, FACT)
    n_kept = F.lit(sum(version.facts.get("rows", {}).values()) if version else 0).cast("long")
    n_read, n_usable = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n_read", "n_usable"))
    return file_list(spark, root).agg(
        n_read.alias("n_read"),
        (n_read - n_usable).alias("n_unusable"),
        (n_usable - n_kept).alias("n_duplicates"),
        n_kept.alias("n_kept"),
    )
