"""Folders of CSV exports -> one frame with the fixed 37-column schema."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.functions.numeric import to_number
from hazeframe.schema import COLUMN_MAP, MEASUREMENTS, MISSING_TOKENS, TABLE_COLUMNS

# Task functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES = "source_dataset string, source_file string, path string, size long, modified timestamp"

TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]X",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd'T'HH:mm[XXX]",
    "yyyy-MM-dd HH:mm[XXX]",
    "yyyy-MM-dd",
)


def empty_measurements(spark: SparkSession) -> DataFrame:
    """No rows, full schema."""
    return spark.createDataFrame([], MEASUREMENTS)


def present(value: Column) -> Column:
    """Text cell, NULL for any of the missing-value tokens."""
    return F.when(~F.trim(value).isin(*MISSING_TOKENS), value)


def parse_timestamp(value: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """UTC instant from the first format that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(fmt)) for fmt in formats])


def conform(df: DataFrame) -> DataFrame:
    """Fixed columns in fixed order: missing ones become typed NULLs, unknown ones are dropped.

    Text values are repaired on the way: numbers by a tolerant cast, timestamps by `parse_timestamp`.
    """
    types = dict(df.dtypes)

    def cell(name: str) -> Column:
        target = MEASUREMENTS[name].dataType
        if name not in types:
            return F.lit(None).cast(target)
        value = F.col(f"`{name}`")
        if types[name] == "string":
            value = present(value)
        if target.simpleString() == "double":
            return to_number(value)
        if target.simpleString() == "timestamp" and types[name] == "string":
            return parse_timestamp(value)
        return value.cast(target)

    return df.select(*[cell(name).alias(name) for name in TABLE_COLUMNS])


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        headers = []
        for path in batch["path"]:
            # Spark prints local paths as file:/x, the file system wants file:///x.
            scheme, _, rest = path.partition(":")
            scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
            uri = f"{scheme}:{rest}" if rest.startswith("//") else f"{scheme}://{rest}"
            files, inner = fs.FileSystem.from_uri(uri)
            with files.open_input_stream(inner) as stream:
                # The first record, however long, and over as many lines as its quotes span.
                lines = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="")
                names = next(csv.reader(lines), [])
            line = io.StringIO()
            csv.writer(line, lineterminator="").writerow(names)
            headers.append(line.getvalue() if any(names) else "")
        yield pd.DataFrame({"path": batch["path"], "header": headers})


def list_files(spark: SparkSession, folder: str, source_dataset: str) -> DataFrame:
    """source_dataset, source_file, path, size, modified of the CSV files of a folder; no file is opened."""
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    return listing.select(
        F.lit(source_dataset).alias("source_dataset"),
        F.substring_index("path", "/", -1).alias("source_file"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def files_by_header(spark: SparkSession, folder: str, files: DataFrame | None = None) -> dict[str, list[str]]:
    """Header line -> CSV files that carry it, or the folder if all of them carry one.

    One scan over files with different headers would match cells by position, so each distinct header
    gets its own scan. Headers are read on the executors; only the file listing, which the driver
    of any file scan holds as well, comes back. `files` (path) are those of the folder to look at, all by default.
    """
    listing = list_files(spark, folder, "") if files is None else files
    headers = listing.select("path").mapInPandas(_read_headers, "path string, header string")
    if files is None:
        different = headers.select("header").distinct().limit(2).collect()
        if len(different) == 1:
            # One header, the usual case: the folder itself is scanned, and no list of its files is gathered.
            return {different[0].header: [folder]}
    groups: dict[str, list[str]] = {}
    for row in headers.orderBy("path").toLocalIterator():
        groups.setdefault(row.header, []).append(row.path)
    return dict(sorted(groups.items()))


def _scan(spark: SparkSession, header: str, paths: list[str], **options: str) -> DataFrame:
    names = next(csv.reader(io.StringIO(header, newline="")))
    # Positional placeholders keep repeated headers apart; the first of each name is used.
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    reader = spark.read.schema(schema).option("header", True).option("pathGlobFilter", "*.csv").options(**options)
    first = {name: i for i, name in reversed(list(enumerate(names)))}
    wanted = [F.col(f"c{i}").alias(COLUMN_MAP[name]) for name, i in first.items() if name in COLUMN_MAP]
    return reader.csv(paths).select(*wanted, F.col("_metadata.file_name").alias("source_file"))


def load_folder(
    spark: SparkSession, folder: str, source_dataset: str, files: DataFrame | None = None, **options: str
) -> DataFrame:
    """All CSV exports of a folder, standardised, with the dataset label and file name of each row; or only `files` (path)
    of it."""
    groups = files_by_header(spark, folder, files)
    result = None
    for header, paths in groups.items():
        if not header.strip():
            continue
        part = conform(
            _scan(spark, header, paths, **options).withColumn("source_dataset", F.lit(source_dataset))
        )
        result = part if result is None else result.unionByName(part)
    return empty_measurements(spark) if result is None else result


def append(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns absent from a frame become NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
