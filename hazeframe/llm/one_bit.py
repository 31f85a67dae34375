"""Approximate nearest neighbours by randomly rotated one-bit codes (Gao and Long, 2024), reranked by exact distances.

Vectors lie in cells around centres learned on a bounded sample. A vector's difference from its centre, turned at random
into more dimensions, is kept as signs: packed bits, its length, and the correction that relates the signs to it. From
these a query estimates inner products, each with a bound on the error; only vectors whose distance may be among the
nearest by that bound are compared in double precision.

Queries and cells meet in two rounds. First each query searches its own cell, which gives a distance that holds its
nearest; then only those cells that can hold a nearer vector, by the triangle inequality. Equal vectors are indexed once,
with as many of their smallest ids as an answer can hold, so that groups of copies cost what one vector costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeframe.llm.buckets import gathered, whole_groups
from hazeframe.llm.common import ROW, cut_lineage, spread, table
from hazeframe.llm.itq import usable

#: Neighbours of a query, and the divisor of the ids that are queries.
NEAREST, EVERY = 10, 100
#: Bits of a code, and standard deviations that an error bound allows: a nearest vector is missed with a chance of 1e-4.
BITS, DEVIATIONS = 512, 4.0
#: Cells at most, distinct vectors for each of them that centres are learned on, and rounds of learning.
CELLS, SAMPLE_A_CELL, ROUNDS = 1024, 8, 8
#: Vectors of a block, queries that meet it at once, and queries in all for which a block is copied once more.
BLOCK, QUERIES, SHARE = 4096, 128, 1 << 16


class Index:
    """What tasks need to know: centres, the random rotation, and how far the sample is from any query."""

    def __init__(self, sample: np.ndarray, cells: int, seed: int = 12):
        random = np.random.Generator(np.random.PCG64(seed))
        dimension = sample.shape[1]
        self.sample = sample
        self.bits = -(-max(BITS, dimension) // 64) * 64
        # The first columns of a random orthogonal matrix: a vector with zeros appended, turned.
        self.turn = np.linalg.qr(random.standard_normal((self.bits, dimension)))[0].T
        self.centres = sample[random.permutation(len(sample))[:cells]].copy()
        for _ in range(ROUNDS):
            cell = self.cells_of(sample)
            sums, counts = np.zeros_like(self.centres), np.bincount(cell, minlength=len(self.centres))
            np.add.at(sums, cell, sample)
            self.centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], self.centres)

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        return np.nan_to_num(distances(vectors, self.centres), nan=np.inf).argmin(axis=1)

    def enough(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """A distance within which each vector has `count` vectors, by the sample alone."""
        if len(self.sample) < count:
            return np.full(len(vectors), np.inf)
        near = np.nan_to_num(distances(vectors, self.sample), nan=np.inf)
        return np.partition(near, count - 1, axis=1)[:, count - 1]


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of two small matrices, correct but for rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        square = (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1)[None, :] - 2 * (left @ right.T)
        return np.sqrt(np.maximum(square, 0))


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distance of each pair of rows: squares added from the first component to the last."""
    with np.errstate(over="ignore"):
        return np.sqrt(np.cumsum((left - right) ** 2, axis=1)[:, -1])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _encoded(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Cell, packed signs, length and correction of each vector."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column("vector"))
        cell = index.cells_of(vectors)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            rest = vectors - index.centres[cell]
            length = np.sqrt((rest * rest).sum(axis=1))
            turned = (rest / length[:, None]) @ index.turn
            signs = turned >= 0
            correction = np.abs(turned).sum(axis=1) / np.sqrt(index.bits)
        codes = [c.tobytes() for c in np.packbits(signs, axis=1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(codes, pa.binary()),
                pa.array(np.nan_to_num(length, nan=np.inf)), pa.array(np.nan_to_num(correction)),
            ],
            ["node", "vector", "cell", "code", "length", "correction"],
        )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: all its members as bytes."""
    for groups, group in whole_groups(batches, ["cell", "part"], BLOCK):
        ends = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for first, last in zip(ends, ends[1:]):
            own = groups.slice(first, last - first).combine_chunks()
            packed = [
                np.ascontiguousarray(own.column("node").to_numpy()).tobytes(), b"".join(own.column("code").to_pylist()),
                np.stack([own.column(c).to_numpy() for c in ("length", "correction")]).tobytes(),
                _matrix(own.column("vector").combine_chunks()).tobytes(),
            ]
            key = [pa.array([own.column(c)[0].as_py()], pa.int32()) for c in ("cell", "part")]
            yield pa.RecordBatch.from_arrays(
                [*key, *(pa.array([p], pa.binary()) for p in packed)], ["cell", "part", "ids", "a", "b", "c"]
            )


def _visits(batches: Iterator[pa.RecordBatch], index: Index, reach: np.ndarray, own: bool, count: int) -> Iterator[pa.RecordBatch]:
    """Blocks of queries for each cell that they visit: their own one, or the others that may hold a vector near enough."""
    for batch in batches:
        for start in range(0, batch.num_rows, QUERIES):
            rows = batch.slice(start, QUERIES)
            vectors, ids = _matrix(rows.column("vector")), rows.column("query").to_numpy()
            enough = rows.column("enough").to_numpy(zero_copy_only=False).astype(float)
            enough = np.fmin(np.where(np.isnan(enough), np.inf, enough), index.enough(vectors, count))
            mine = index.cells_of(vectors)
            if own:
                visit = np.zeros((len(ids), len(index.centres)), dtype=bool)
                visit[np.arange(len(ids)), mine] = True
            else:
                with np.errstate(invalid="ignore"):
                    least = distances(vectors, index.centres) - reach[None, :]
                visit = ~(least * (1 - 1e-9) > enough[:, None] * (1 + 1e-9)) & (reach >= 0)[None, :]
                visit[np.arange(len(ids)), mine] = False
            for cell in np.flatnonzero(visit.any(axis=0)).tolist():
                chosen = visit[:, cell]
                packed = [np.ascontiguousarray(x[chosen]).tobytes() for x in (ids, enough, vectors)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)], ["cell", "ids", "a", "b"]
                )


def signs_of(codes: np.ndarray) -> np.ndarray:
    return np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1


def search_block(
    nodes: np.ndarray, signs: np.ndarray, scalars: np.ndarray, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray,
    wanted: np.ndarray, enough: np.ndarray, count: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the query, node, distance) of each query's `count` nearest within `enough`, and those as far as the last.

    `signs` are the codes as 1 and -1, scalars their lengths and corrections.
    """
    bits = turn.shape[1]
    length, correction = scalars
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        rest = wanted - centre
        size = np.sqrt((rest * rest).sum(axis=1))
        along = (rest @ turn / size[:, None]).astype(np.float32) @ signs.T / np.sqrt(bits)
        estimate = along / correction[None, :]
        error = DEVIATIONS * np.sqrt(np.maximum(1 - correction**2, 0)) / (correction * np.sqrt(max(1, bits - 1))) + 1e-5
        base, product = size[:, None] ** 2 + length[None, :] ** 2, 2 * size[:, None] * length[None, :]
        # A cosine is at most one; where a length is zero or too large to square, nothing is ruled out.
        least = base - product * np.minimum(estimate + error[None, :], 1)
        least = np.where(np.isfinite(least), least, np.where(product == 0, base, -np.inf)) - 1e-9 * base
        least = np.where(np.isnan(least), -np.inf, least)
        # The nearest by estimate give a distance that holds `count` vectors.
        if len(nodes) > count:
            likely = np.argpartition(least, count - 1, axis=1)[:, :count]
            held = exact(vectors[likely.ravel()], np.repeat(wanted, count, axis=0)).reshape(len(wanted), count).max(axis=1)
            enough = np.fmin(enough, held)
        query, member = np.nonzero(least <= (enough * enough * (1 + 1e-9))[:, None])
    score = np.concatenate(
        [exact(vectors[member[s : s + BLOCK]], wanted[query[s : s + BLOCK]]) for s in range(0, len(query), BLOCK)] or [np.zeros(0)]
    )
    order = np.lexsort((nodes[member], score, query))
    query, member, score = query[order], member[order], score[order]
    # Ties at the last place stay, as their ids decide.
    first, end = (np.searchsorted(query, np.arange(len(wanted)), side=side) for side in ("left", "right"))
    if len(query):
        last = score[np.clip(np.minimum(first + count, end) - 1, 0, None)]
        near = score <= last[query]
        query, member, score = query[near], member[near], score[near]
    return query, nodes[member], score


def _searched(batches: Iterator[pa.RecordBatch], index: Index, count: int) -> Iterator[pa.RecordBatch]:
    """A block comes first, then the queries that visit it."""
    dimension = index.centres.shape[1]
    block: tuple = ()
    for batch in batches:
        for row in range(batch.num_rows):
            cell, ids, *packed = (batch.column(c)[row].as_py() for c in ("cell", "ids", "a", "b", "c"))
            ids = np.frombuffer(ids, np.int64)
            if batch.column("asking")[row].as_py():
                wanted = np.frombuffer(packed[1]).reshape(-1, dimension)
                query, node, score = search_block(*block, index.centres[cell], index.turn, wanted, np.frombuffer(packed[0]), count)
                yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(node), pa.array(score)], ["query", "node", "score"])
            else:
                codes = np.frombuffer(packed[0], np.uint8).reshape(len(ids), -1)
                block = ids, signs_of(codes), np.frombuffer(packed[1]).reshape(2, -1), np.frombuffer(packed[2]).reshape(-1, dimension)


def _distinct(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(name, vector) for each distinct vector, by its first row; and `name`, vec_id, ROW of all rows."""
    first = rows.groupBy("hash", "vector").agg(F.min(ROW).alias(name))
    joined = rows.join(spread(first), ["hash", "vector"]).select(name, "vec_id", ROW)
    return first.select(name, "vector"), joined


def nearest(
    vectors: DataFrame, queries: DataFrame, count: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the `count` nearest rows of `vectors` to each row of `queries`.

    `queries` are (ROW, vec_id, vector), rows of `usable(vectors)`; each finds every row but itself. score is the
    Euclidean distance in double precision; ties go to the smaller vec_id (null last), then to the earlier row; where there are
    fewer rows all are found. Vectors that are null, zero or hold null or non-finite components take no part, and vectors
    meet those of their own dimension only. Rows that repeat a vector are candidates each; a repeated query id is answered
    each time. A distance beyond the range of doubles is infinite. An empty table gives no rows. Centres are learned on
    at most CELLS * SAMPLE_A_CELL distinct vectors, chosen by hash; all are indexed. A vector within the true nearest is
    missed only if its estimate is off by more than DEVIATIONS standard deviations.
    """
    plain = F.transform("vector", lambda x: x + F.lit(0.0))  # -0.0 and 0.0 are the same place
    rows = usable(vectors, vec_id, embedding).where("fit").withColumn("vector", plain)
    rows = rows.select(ROW, "vec_id", "vector", F.size("vector").alias("dimension"), F.xxhash64("vector").alias("hash"))
    asked = queries.withColumn("vector", plain).withColumn("hash", F.xxhash64("vector"))
    found = None
    # One search for each length of vectors; a table usually has one.
    for dimension in [r.dimension for r in rows.select("dimension").distinct().orderBy("dimension").collect()]:
        part = _nearest(rows.where(F.col("dimension") == dimension), asked.where(F.size("vector") == dimension), count)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    return found


def _nearest(rows: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    # Of equal vectors the smallest ids, one more than an answer holds, as a query leaves itself out.
    by_id = Window.partitionBy("hash", "vector").orderBy(F.col("vec_id").asc_nulls_last(), ROW)
    few = rows.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= count + 1)
    ids = F.sort_array(F.collect_list(F.struct("place", "vec_id", ROW))).alias("ids")
    classes = cut_lineage(few.groupBy("hash", "vector").agg(ids).withColumn("node", F.col("ids")[0][ROW]).drop("hash"))
    size = classes.count()
    cells = int(min(CELLS, max(1, size**0.5 / 2)))
    chosen = classes.select(F.xxhash64("vector", F.lit(1)).alias("h"), "vector").orderBy("h", "vector").limit(cells * SAMPLE_A_CELL)
    index = Index(np.array([r.vector for r in chosen.select("vector").collect()], dtype=np.float64), cells)
    schema = "node long, vector array<double>, cell int, code binary, length double, correction double"
    coded = cut_lineage(classes.select("node", "vector").mapInArrow(partial(_encoded, index=index), schema))
    # Reach and number of vectors of each cell: as many rows as there are centres.
    sizes = coded.groupBy("cell").agg(F.max("length").alias("reach"), F.count("*").alias("n")).collect()
    reach = np.full(len(index.centres), -1.0)
    for r in sizes:
        reach[r.cell] = r.reach
    parts = {r.cell: -(-r.n // BLOCK) for r in sizes}
    part_count = F.element_at(F.create_map(*(F.lit(x) for pair in parts.items() for x in pair)), F.col("cell"))
    parted = coded.withColumn("part", F.pmod(F.xxhash64("node"), part_count).cast("int"))
    packed = "cell int, part int, ids binary, a binary, b binary, c binary"
    blocks = cut_lineage(gathered(parted, "cell", "part").mapInArrow(_blocks, packed))
    wanted, askers = _distinct(queries, "query")
    wanted = cut_lineage(wanted)
    # Where many queries may visit a block, copies of it stand in several tasks.
    copies = -(-wanted.count() // SHARE)
    blocks = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(max(0, copies - 1)))).alias("copy"), F.lit(False).alias("asking"))

    def round_of(asking: DataFrame, own: bool) -> DataFrame:
        visit = partial(_visits, index=index, reach=reach, own=own, count=count + 1)
        visits = asking.mapInArrow(visit, "cell int, ids binary, a binary, b binary").withColumns(
            {"c": F.lit(None).cast("binary"), "copy": F.pmod(F.xxhash64("ids"), F.lit(max(1, copies))).cast("int"), "asking": F.lit(True)}
        )
        met = blocks.unionByName(visits.withColumn("part", F.explode(F.sequence(F.lit(0), part_count - 1))))
        met = met.repartition("cell", "part", "copy").sortWithinPartitions("cell", "part", "copy", "asking")
        return met.mapInArrow(partial(_searched, index=index, count=count + 1), "query long, node long, score double")

    # An answer takes rows, and each vector found has one at least.
    first = cut_lineage(round_of(wanted.withColumn("enough", F.lit(float("inf"))), True))
    best = Window.partitionBy("query").orderBy("score", "node")
    known = first.withColumn("place", F.row_number().over(best)).where(F.col("place") == count + 1)
    asking = wanted.join(known.select("query", F.col("score").alias("enough")), "query", "left")
    hits = first.unionByName(round_of(asking, False))
    hits = hits.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy("score"))).where(F.col("place") <= count + 1)
    listed = hits.join(classes.select("node", "ids"), "node").select("query", "score", F.inline("ids"))
    by_score = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), ROW)
    listed = listed.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= count + 1)
    askers = askers.select("query", F.col("vec_id").alias("query_id"), F.col(ROW).alias("asker"))
    answers = askers.join(spread(listed.drop("place")), "query").where(F.col(ROW) != F.col("asker"))
    by_score = Window.partitionBy("asker").orderBy("score", F.col("vec_id").asc_nulls_last(), ROW)
    ranked = answers.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    queries = usable(vectors, "vec_id", "embedding").where(F.col("fit") & (F.col("vec_id") % EVERY == 0)).select(ROW, "vec_id", "vector")
    return nearest(vectors, queries)


#: All distances, in the same order of additions.
ORACLE = f"""
WITH kept AS (
  SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    sqrt(list_reduce([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(q.v, c.v)], lambda a, b: a + b)) AS score
  FROM kept AS q JOIN kept AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= {NEAREST}"""
