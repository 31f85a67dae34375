"""Versions of a folder: data first, then one small commit file that makes it visible.

A versioned folder holds `_commits/00000007.json`, each naming the folders that make up one version, and the data itself in
folders that carry the version's token, `version=v00000007-1f2e3d4c`. Readers take the newest commit that can be read; what
a job that was killed leaves behind belongs to no commit and isn't seen. A version may share folders with the one before it, so
that replacing one month of a table writes that month alone. Two writers that start from the same version can't both commit.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DATA, COMMITS = "data", "_commits"
#: Partition column that tells versions apart; readers don't see it.
VERSION = "version"


class ConcurrentWrite(RuntimeError):
    """Another job has committed since this one began."""


@dataclass(frozen=True)
class Version:
    """One committed state: folders relative to `path`, the schema of the table, facts that the writer counted, and folders
    that belong to the version beside its rows."""

    path: str
    number: int
    folders: tuple[str, ...]
    schema: T.StructType | None = None
    facts: dict = field(default_factory=dict)
    beside: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        """The table. Only the listed folders are scanned; partition columns come from their names."""
        if not self.folders:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.option("basePath", f"{self.path}/{DATA}")
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.parquet(*(f"{self.path}/{f}" for f in self.folders)).drop(VERSION)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, if it is there."""
    files, at = file_system(spark, path)
    files.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order."""
    files, at = file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(at) or [])


def _commit_numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name.rsplit("/", 1)[1].split(".")[0]) for name in matching(spark, f"{path}/{COMMITS}/*.json")]


def _commit_path(path: str, number: int) -> str:
    return f"{path}/{COMMITS}/{number:08d}.json"


def _parsed(spark: SparkSession, path: str, number: int) -> Version | None:
    files, at = file_system(spark, _commit_path(path, number))
    stream = files.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        said = json.loads(text)
    except ValueError:
        return None  # cut off: its writer was killed before it was done
    schema = said["schema"] and T.StructType.fromJson(said["schema"])
    return Version(path, number, tuple(said["folders"]), schema, said["facts"], tuple(said["beside"]))


def history(spark: SparkSession, path: str) -> list[Version]:
    """All versions that can be read, oldest first."""
    found = (_parsed(spark, path, number) for number in _commit_numbers(spark, path))
    return [version for version in found if version]


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version; None where nothing was committed."""
    for number in reversed(_commit_numbers(spark, path)):
        version = _parsed(spark, path, number)
        if version:
            return version
    return None


class Writing:
    """A version in the making: write below `folder`, then `commit` the folders."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.before = current(spark, self.path)
        self.number = max(_commit_numbers(spark, self.path), default=0) + 1
        self.token = f"v{self.number:08d}-{uuid.uuid4().hex[:8]}"
        #: Where a version without further partitions goes.
        self.folder = f"{DATA}/{VERSION}={self.token}"

    def commit(
        self, folders: Iterable[str], schema: T.StructType | None = None, facts: dict | None = None, beside: Iterable[str] = ()
    ) -> Version:
        """Make the version visible. The commit file is created whole or not at all, and only if its number is free."""
        made = Version(self.path, self.number, tuple(folders), schema, facts or {}, tuple(beside))
        said = {"folders": made.folders, "schema": schema and schema.jsonValue(), "facts": made.facts, "beside": made.beside}
        files, at = file_system(self.spark, _commit_path(self.path, self.number))
        try:
            stream = files.create(at, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                raise ConcurrentWrite(f"{self.path}: version {self.number} was committed by another job") from None
            raise
        try:
            stream.write(json.dumps(said).encode())
        finally:
            stream.close()
        return made


def drop_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove all but the newest `keep` versions, and what killed jobs have left. Returns the number of folders removed.

    Folders of a number above the newest commit belong to jobs that may still run, and stay.
    """
    path = path.rstrip("/")
    versions = history(spark, path)
    kept = versions[-keep:]
    if not kept:
        return 0
    used = {folder for version in kept for folder in (*version.folders, *version.beside)}
    removed = 0
    # Commit files first: a version that can be read has all its folders.
    for number in _commit_numbers(spark, path):
        if number < kept[0].number:
            delete(spark, _commit_path(path, number))
    files, at = file_system(spark, path)
    base = files.makeQualified(at).toString() + "/"
    for pattern in (f"*/{VERSION}=*", f"*/*/{VERSION}=*"):
        for folder in matching(spark, base + pattern):
            number = int(re.search(rf"/{VERSION}=v(\d+)-", folder)[1])
            if number <= kept[-1].number and folder.removeprefix(base) not in used:
                delete(spark, folder)
                removed += 1
    return removed
