"""Small helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import hazeframe
from hazeframe.session import cut_lineage

#: Name of the row number that stages add beside the columns of their input.
ROW = "__row__"

__all__ = ["ROW", "ascii_lower", "cut_lineage", "id_and_text", "ship", "slices", "spread", "table", "without_rows", "words_of"]


#: Applications that the code was sent to, with the folder of the archive, which Spark serves as long as it runs.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this library's code to the executors, once for each application, so that Python tasks find it there."""
    context, package = spark.sparkContext, Path(hazeframe.__file__).parent
    if context.applicationId in _shipped or not package.is_dir():
        return  # sent before, or itself from an archive that was sent
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix="hazeframe-code-")
    archive = Path(folder.name) / "hazeframe-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the test tables, read by Spark wherever the folder lies."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, rows: bool = False) -> DataFrame:
    """The two columns that an operator needs, so that other columns can't clash; null text is empty.

    `rows` adds ROW, a number for each input row. It depends on file splits only, so `docs` must be a scan (with
    filters or projections), as it is wherever a table was read; two readings then give equal numbers.
    """
    ship(docs.sparkSession)
    columns = [F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")]
    return docs.select(*columns, *([F.monotonically_increasing_id().alias(ROW)] if rows else []))


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """`docs`, a scan, without the rows that `rows` numbers (ROW, as by `id_and_text`); all its columns stay.

    Only numbers move while those left out are few enough, as counted, for Spark's own limit of a broadcast; beyond it the
    join is an ordinary one.
    """
    rows = cut_lineage(rows.select(ROW))
    most = docs.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if 16 * rows.count() <= most:
        rows = F.broadcast(rows)
    name = ROW
    while name in docs.columns:
        name += "_"
    numbered = docs.withColumn(name, F.monotonically_increasing_id())
    return numbered.join(rows.withColumnRenamed(ROW, name), name, "left_anti").drop(name)


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only, whatever the language."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spread(df: DataFrame) -> DataFrame:
    """`df` dealt out anew, without regard to keys, so that a join on the key it was grouped by shuffles both sides itself;
    only then can Spark split a key that holds a large part of the other side's rows."""
    return df.hint("rebalance")


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split()


def slices(batches: Iterable[pa.RecordBatch], most: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most`, so that a task holds the results of few rows at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)
