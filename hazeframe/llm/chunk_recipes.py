"""Exact deduplication by content-defined chunk recipes.

A text is cut where a rolling hash of the last 32 bytes says so; its recipe is the ordered list of chunk identifiers.
Chunk contents cross the network once, each at most once a task, to verify that equal identifiers mean equal bytes;
after that only recipes are compared, so long documents aren't moved or compared again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.common import ROW, cut_lineage, id_and_text, slices, spread, table, without_rows

LEAST, MEAN_BITS, MOST = 512, 11, 16_384
#: Bytes of chunk contents that a task remembers in order to send each of them once.
REMEMBERED = 32 << 20
WINDOW = 32


def _gear() -> np.ndarray:
    """A fixed pseudo-random word for each byte value."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(16)).astype(np.uint32)


GEAR = _gear()


def _marks(data: np.ndarray) -> np.ndarray:
    """Positions after which the hash of the last WINDOW bytes allows a cut."""
    found = []
    step = 1 << 18
    for start in range(0, len(data), step):
        first = max(0, start - WINDOW)
        h = GEAR[data[first : start + step]]
        for shift in (1, 2, 4, 8, 16):
            if len(h) > shift:
                longer = h.copy()
                longer[shift:] += h[:-shift] << np.uint32(shift)
                h = longer
        at = np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + first + 1
        found.append(at[at > start])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of `data` end; they hold LEAST to MOST bytes, but for the last, and depend on the bytes only."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    ends, last = [], 0
    marks = _marks(np.frombuffer(data, dtype=np.uint8)).tolist()
    for mark in [*marks, len(data)]:
        while mark - last > MOST:
            last += MOST
            ends.append(last)
        if mark - last >= LEAST or mark == len(data) > last:
            ends.append(last := mark)
    return ends


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _chunks(text: str) -> Iterator[bytes]:
    data, last = text.encode().lower(), 0
    for end in chunk_ends(data):
        yield data[last:end]
        last = end


def _recipes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        recipes = [b"".join(_digest(c, size) for c in _chunks(t)) for t in texts]
        hashes = [hashlib.sha256(t.encode().lower()).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(ROW), batch.column("doc_id"), pa.array(recipes, pa.binary()), pa.array(hashes, pa.binary())],
            [ROW, "doc_id", "recipe", "sha"],
        )


def _contents(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, bytes] = {}
    held = 0
    for batch in slices(batches):
        out = []
        for text in batch.column("text").to_pylist():
            for chunk in _chunks(text):
                digest = _digest(chunk, size)
                if seen.get(digest) == chunk:
                    continue
                out.append((digest, chunk))
                if digest not in seen:
                    held += len(chunk) + 200
                    if held > REMEMBERED:
                        seen, held = {}, 0
                    seen[digest] = chunk
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in out], pa.binary()), pa.array([c for _, c in out], pa.binary())], ["digest", "content"]
        )


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t.encode().lower() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(texts, pa.binary())], [ROW, "whole"])


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, digest_bytes: int = 16) -> DataFrame:
    """One row for each row of `docs`: ROW, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, after lower-casing A-Z. Null text counts as empty, and empty texts equal each
    other. The largest doc_id of a group stays (nulls lose to any number; keep_id is null if all are null); of rows that
    tie on it, one stays, the last by ROW. An empty table gives an empty result. Documents holding a chunk whose
    identifier two different chunks share are compared by their whole bytes (practically only with few `digest_bytes`).
    """
    rows = id_and_text(docs, doc_id, text, rows=True)
    map_rows: Callable = partial(_recipes, size=digest_bytes)
    recipes = cut_lineage(rows.mapInArrow(map_rows, f"{ROW} long, doc_id long, recipe binary, sha binary"))
    contents = rows.select("text").mapInArrow(partial(_contents, size=digest_bytes), "digest binary, content binary")
    shared = contents.distinct().groupBy("digest").count().where("count > 1").select("digest")
    keyed = recipes.withColumn("key", F.struct("recipe", F.lit(None).cast("binary").alias("whole")))
    if not shared.isEmpty():
        keyed = _with_whole_texts(rows, recipes, shared, digest_bytes)
    best = F.max(F.struct("doc_id", ROW))
    groups = spread(keyed.groupBy("key").agg(best.alias("best"), F.count("*").alias("group_size")))
    return keyed.join(groups, "key").select(
        ROW,
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"),
        F.hex("sha").alias("text_sha256"),
    ).withColumn("text_sha256", F.lower("text_sha256"))


def _with_whole_texts(rows: DataFrame, recipes: DataFrame, shared: DataFrame, size: int) -> DataFrame:
    """Recipes with a key that also holds the whole text where an ambiguous identifier occurs."""
    last = (F.length("recipe") / size - 1).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring("recipe", i * size + 1, F.lit(size)))
    used = recipes.where(F.length("recipe") > 0).select(ROW, F.explode(parts).alias("digest"))
    doubtful = used.join(shared, "digest").select(ROW).distinct()
    whole = rows.mapInArrow(_normal, f"{ROW} long, whole binary").join(doubtful, ROW)
    return cut_lineage(
        recipes.join(whole, ROW, "left").select(
            ROW, "doc_id", "sha", F.struct(F.when(F.col("whole").isNull(), F.col("recipe")).alias("recipe"), "whole").alias("key")
        )
    )


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents")).drop(ROW)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: of equal texts, the row that stays.

    Null and empty texts are one group; ties and repeated rows are settled as by `exact_duplicates`. All columns stay,
    whatever their names; an empty table stays empty.
    """
    return without_rows(docs, exact_duplicates(docs).where("NOT kept"))


ORACLE = r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""
