"""Quality of texts as an ordinal regression on graded ratings.

A cumulative-link model: with grades 0 .. K - 1, P(grade >= k) = sigmoid(w.x - threshold k). The weights w over hashed text
features are shared by all grades, the thresholds ascend. A text's expected grade is the sum of its tail probabilities,
and documents are selected by the tail probability of the least grade wanted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.common import cut_lineage, id_and_text, slices, table

#: Rated texts that are learned from, at most, chosen by hash of their doc_id.
SAMPLE = 6_000
#: Hashed features; steps of learning; strength of the penalty on the weights.
BUCKETS, STEPS, PENALTY = 1 << 13, 150, 1e-4
#: A document stays if it has this grade or more with at least this probability. Low, so that clean texts stay.
WANTED, LEAST = 1, 0.3

_BYTES = np.arange(256)
_CAPITALS = (_BYTES >= 65) & (_BYTES <= 90)
_ODD = (_BYTES < 128) & np.array([not (chr(b).isalpha() or chr(b).isspace() or chr(b) in ".,") for b in range(256)])


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % (BUCKETS - 1) + 1


def _shape(token: str) -> str:
    """What a token looks like: letters of either case and digits as one sign for each run, other signs as they are."""
    out = []
    for c in token:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class _Known(dict):
    """Results of a function, remembered for short keys until there are too many."""

    def __init__(self, compute: Callable, longest: int = 48, most: int = 200_000):
        self.compute, self.longest, self.most = compute, longest, most

    def __missing__(self, key):
        result = self.compute(key)
        if len("".join(key)) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = result
        return result


def _token(token: str) -> tuple[str, int, int]:
    """A token's shape, its bucket, and that of its letters."""
    shape = _shape(token)
    return shape, _bucket("s:" + shape), _bucket("w:" + "".join(filter(str.isalpha, token.lower())))


_tokens = _Known(_token)
_pairs = _Known(lambda pair: _bucket("p:" + " ".join(pair)))


def hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of a text: words, shapes, pairs of shapes, repeated words and lines, length; bucket 0 is constant.

    Values are square roots of shares of the tokens, so that they don't grow with the text; all of it counts.
    """
    tokens = text.split()
    n = len(tokens)
    if not n:
        return np.array([0, _bucket("empty")]), np.array([1.0, 1.0])
    different = Counter(tokens)
    known = {token: _tokens[token] for token in different}
    shapes = [known[token][0] for token in tokens]
    counts: dict[int, float] = {}
    for token, times in different.items():
        _, shape, word = known[token]
        counts[shape] = counts.get(shape, 0.0) + times
        counts[word] = counts.get(word, 0.0) + times
    for pair, times in Counter(zip(shapes, shapes[1:])).items():
        bucket = _pairs[pair]
        counts[bucket] = counts.get(bucket, 0.0) + times
    lines = [line for line in text.split("\n") if line.strip()]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    shares = {
        "again": sum(map(eq, tokens, tokens[1:])) / n,
        "few words": 1 - len(different) / n,
        "same lines": 1 - len(set(lines)) / max(1, len(lines)),
        "odd signs": _ODD[data].mean(),
        "capitals": _CAPITALS[data].mean(),
        f"length {min(12, n.bit_length())}": 0.25,
    }
    buckets = np.fromiter(counts, dtype=np.int64, count=len(counts))
    values = np.sqrt(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) / n)
    own = np.array([_bucket(name) for name in shares])
    return np.concatenate([[0], own, buckets]), np.concatenate([[1.0], np.sqrt(list(shares.values())), values])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Shared weights and ascending thresholds, one for each grade from 1 on."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        buckets, values = hashed(text)
        return _sigmoid(float(self.weights[buckets] @ values) - self.thresholds)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, count: int, steps: int = STEPS) -> Ordinal:
    """The model of least mean loss -log P(grade) plus PENALTY |w|^2, by Adam over all rows.

    Thresholds are the first one and the logarithms of the gaps between them, so that they stay in order.
    """
    sizes = np.array([len(b) for b, _ in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    bucket, value = np.concatenate([b for b, _ in rows]), np.concatenate([v for _, v in rows])
    shares = np.array([(grades >= k).mean() for k in range(1, count)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(shares / (1 - shares))
    # Values: thresholds as (first, log gaps), then the weights; the constant feature is held by the thresholds.
    state = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2)), np.zeros(BUCKETS)])
    first, second = np.zeros_like(state), np.zeros_like(state)
    low, high = grades > 0, grades < count - 1
    for step in range(1, steps + 1):
        gaps = np.exp(state[1 : count - 1])
        thresholds = state[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        weights = state[count - 1 :]
        z = np.bincount(row, weights[bucket] * value, minlength=len(rows))
        # P(grade) is the difference of two tails; the ends lack one of them.
        upper = np.where(low, _sigmoid(z - thresholds[np.maximum(grades - 1, 0)]), 1.0)
        lower = np.where(high, _sigmoid(z - thresholds[np.minimum(grades, count - 2)]), 0.0)
        chance = np.maximum(upper - lower, 1e-9)
        by_upper, by_lower = upper * (1 - upper) / chance / len(rows), lower * (1 - lower) / chance / len(rows)
        by_z = by_lower - by_upper
        by_threshold = np.bincount(np.maximum(grades - 1, 0)[low], by_upper[low], minlength=count - 1)
        by_threshold -= np.bincount(np.minimum(grades, count - 2)[high], by_lower[high], minlength=count - 1)
        by_state = np.zeros_like(state)
        by_state[0] = by_threshold.sum()
        by_state[1 : count - 1] = gaps * np.cumsum(by_threshold[::-1])[::-1][1:]
        by_state[count - 1 :] = np.bincount(bucket, by_z[row] * value, minlength=BUCKETS) + 2 * PENALTY * weights
        by_state[count - 1] = 0.0
        first, second = 0.9 * first + 0.1 * by_state, 0.99 * second + 0.01 * by_state**2
        state -= 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    thresholds = state[0] + np.concatenate([[0.0], np.cumsum(np.exp(state[1 : count - 1]))])
    return Ordinal(state[count - 1 :], thresholds)


def _hashed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [hashed(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("grade"),
                pa.array([b.tolist() for b, _ in found], pa.list_(pa.int32())),
                pa.array([v.tolist() for _, v in found], pa.list_(pa.float32())),
            ],
            ["grade", "buckets", "values"],
        )


def learn(docs: DataFrame, ratings: DataFrame, *, sample: int = SAMPLE) -> Ordinal | None:
    """A model from texts (doc_id, text) and ratings (doc_id, grade: 0, 1, ...); None without two grades.

    At most `sample` ratings are used, chosen by hash of their doc_id; null grades and doc_ids are left out. Of the texts
    of a repeated doc_id, the one of smallest hash is learned from. Grades that nobody gave, up to the greatest that was,
    are kept as grades.
    """
    rated = ratings.where("grade IS NOT NULL AND doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    rated = cut_lineage(rated)
    texts = docs.join(F.broadcast(rated.select("doc_id").distinct()), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    chosen = texts.join(F.broadcast(rated), "doc_id").select("least.text", "grade")
    found = chosen.mapInArrow(_hashed_rows, "grade long, buckets array<int>, values array<float>").toArrow()
    grades = found.column("grade").to_numpy().astype(np.int64)
    if len(set(grades.tolist())) < 2:
        return None
    rows = [(np.asarray(b, dtype=np.int64), np.asarray(v, dtype=np.float64)) for b, v in zip(found.column("buckets").to_numpy(), found.column("values").to_numpy())]
    return fit(rows, grades, int(grades.max()) + 1)


def _scored(batches: Iterator[pa.RecordBatch], model: Ordinal) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        tails = [model.tails(t).tolist() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tails, pa.list_(pa.float64()))], ["doc_id", "tails"])


def _selected(batches: Iterator[pa.RecordBatch], model: Ordinal, wanted: int, least: float) -> Iterator[pa.RecordBatch]:
    """The rows that stay, whole."""
    for batch in slices(batches):
        tails = (model.tails(t or "") for t in batch.column("text").to_pylist())
        yield batch.filter(pa.array([len(p) < wanted or p[wanted - 1] >= least for p in tails], pa.bool_()))


def graded(
    docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", *, wanted: int = WANTED, least: float = LEAST
) -> DataFrame:
    """doc_id, expected_grade, tails (P(grade >= 1), ...), tail (that of `wanted`), kept for each row of `docs`.

    `ratings` holds (doc_id, grade). kept: tail is `least` or more. Null text counts as empty; empty texts are graded like
    others. Without two different grades nothing can be learned: everything is kept, with null grades. Repeated rows are
    graded alike.
    """
    given = id_and_text(docs, doc_id, text)
    model = learn(given, ratings)
    if model is None:
        none = F.lit(None)
        return given.select(
            "doc_id", none.cast("double").alias("expected_grade"), none.cast("array<double>").alias("tails"), none.cast("double").alias("tail"), F.lit(True).alias("kept")
        )
    scored = given.mapInArrow(partial(_scored, model=model), "doc_id long, tails array<double>")
    return scored.select(
        "doc_id",
        F.aggregate("tails", F.lit(0.0), lambda total, p: total + p).alias("expected_grade"),
        "tails",
        F.get("tails", F.lit(wanted - 1)).alias("tail"),
    ).withColumn("kept", F.coalesce(F.col("tail") >= least, F.lit(True)))


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades of the labelled documents: 0 for poor ones, 1 for good but toxic ones, 2 for good ones."""
    good = F.when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2)).when(F.col("quality") == 0, 0)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), good.cast("long").alias("grade"))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return graded(table(spark, folder, "documents"), ratings_of(table(spark, folder, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: documents of the wanted grade stay, with all their columns; no row is moved for it.

    Null and empty texts are graded like others, repeated rows alike; without two grades in the labels all documents stay,
    and an empty table stays empty.
    """
    model = learn(id_and_text(docs), ratings_of(table(spark, folder, "labels")))
    if model is None:
        return docs
    return docs.mapInArrow(partial(_selected, model=model, wanted=WANTED, least=LEAST), docs.schema)
