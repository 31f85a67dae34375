"""From raw documents to packed training sequences: the stages, each over all that the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazeframe.llm.chunk_recipes import drop_exact_duplicates
from hazeframe.llm.minhash import drop_near_duplicates
from hazeframe.llm.ordinal import drop_poor
from hazeframe.llm.packing import pack_stage
from hazeframe.llm.secrets import mask_stage
from hazeframe.session import ensure_checkpoint_dir, released_checkpoints
from hazeframe.sources.versions import delete

#: (name, function of (spark, docs, folder of the tables)); all but the last return the columns of documents.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_poor),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_stage),
    ("packing", pack_stage),
]

#: No SQL states a fitted classifier or a shortest path over token windows; tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents`; each stage's result is a Parquet table in the shared checkpoint folder.

    Once a stage's table is written, its checkpoints and the table that it read are deleted: a later stage that loses
    executors reads the last table again. Nulls, empty texts, ties and repeated rows are treated as the stages say; of
    further columns those that documents have stay up to the last stage, and no documents give no pieces.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        with released_checkpoints(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if read:
            delete(spark, read)
        docs, read = spark.read.parquet(path), path
    return docs
