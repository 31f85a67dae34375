"""Vector code compression: product codes by Lloyd's rounds over two trees, in whole numbers.

Vectors become integers and are cut into parts; each part position has a small codebook. Vectors are held in chunks, each
with one tree for every position: nodes are boxes around the parts below them, with cached sums. A second tree holds the
codebook's entries. Going down both, distance bounds between two boxes rule out combinations; a node for which one entry
is left is assigned whole through its cached sum, and only the parts of leaves that stay uncertain are compared one by one.

A round sends the codebooks to the chunks and brings one sum back for each entry and place, whatever the number of rows.
Integers make the result independent of chunks, partitions and the order of sums.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import cut_lineage, ship, spread, table

#: Parts of a vector, entries of a codebook at most, rounds, and what components are multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a chunk, and parts below a leaf of its trees.
CHUNK, LEAF = 4096, 32
#: Integers beyond this are held at it, so that squared distances stay below 2**63 in up to 500 dimensions.
MOST = 1 << 26

Books = list[np.ndarray]


@dataclass
class PartTree:
    """A balanced tree over the parts of one position: `order` lists the rows, level by level nodes have equal shares of it."""

    order: np.ndarray
    points: np.ndarray
    edges: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @classmethod
    def over(cls, points: np.ndarray, leaf: int = LEAF) -> PartTree:
        n, depth = len(points), 0
        while n >> depth > leaf:
            depth += 1
        edges = (np.arange((1 << depth) + 1) * n) >> depth
        order = np.arange(n, dtype=np.int32)
        for level in range(depth):
            step = 1 << (depth - level)
            for node in range(1 << level):
                first, last = edges[node * step], edges[(node + 1) * step]
                middle = edges[node * step + step // 2] - first
                own = points[order[first:last]]
                if own.shape[1]:
                    widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                    order[first:last] = order[first:last][np.argpartition(own[:, widest], middle)]
        sorted_points = points[order].astype(np.int64)
        low = [np.minimum.reduceat(sorted_points, edges[:-1], axis=0)]
        high = [np.maximum.reduceat(sorted_points, edges[:-1], axis=0)]
        sums = [np.add.reduceat(sorted_points, edges[:-1], axis=0)]
        for _ in range(depth):
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
            sums.insert(0, sums[0][::2] + sums[0][1::2])
        return cls(order, points[order], edges, low, high, sums)

    def bounds(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of nodes in `order`."""
        step = (len(self.edges) - 1) >> level
        return self.edges[nodes * step], self.edges[(nodes + 1) * step]


class EntryTree:
    """Codebook entries in groups that halve from level to level, each with the box around its entries."""

    def __init__(self, book: np.ndarray):
        self.book = book.astype(np.int64)
        groups = [np.arange(len(book))]
        self.levels: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]] = []
        while any(len(g) > 1 for g in groups):
            halves = []
            for group in groups:
                own = self.book[group]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if own.shape[1] else 0
                ranked = group[np.argsort(own[:, widest], kind="stable")] if own.shape[1] else group
                halves += [np.sort(h) for h in np.array_split(ranked, 2) if len(h)]
            groups = halves
            if any(len(g) > 1 for g in groups):
                low = np.stack([self.book[g].min(axis=0) for g in groups])
                high = np.stack([self.book[g].max(axis=0) for g in groups])
                self.levels.append((groups, low, high))

    def narrowed(self, low: np.ndarray, high: np.ndarray, possible: np.ndarray) -> np.ndarray:
        """Which of the `possible` entries may be nearest to some point of each box (node x entry)."""
        possible = possible.copy()
        for groups, group_low, group_high in self.levels:
            alive = np.stack([possible[:, g].any(axis=1) for g in groups], axis=1)
            near, far = _box_distances(low, high, group_low, group_high)
            enough = np.where(alive, far, np.iinfo(np.int64).max).min(axis=1)
            for i, group in enumerate(groups):
                possible[np.ix_(near[:, i] > enough, group)] = False
        near, far = _box_distances(low, high, self.book, self.book)
        far = np.where(possible, far, np.iinfo(np.int64).max)
        best = far.argmin(axis=1)
        possible &= near <= far.min(axis=1)[:, None]
        # The best entry against each other one over the whole box: the greatest difference of their distances there.
        ahead = self.book[None, :, :] - self.book[best][:, None, :]
        corner = np.where(ahead > 0, high[:, None, :], low[:, None, :])
        squares = (self.book * self.book).sum(axis=1)
        worst = 2 * (corner * ahead).sum(axis=2) + squares[best][:, None] - squares[None, :]
        behind = (worst < 0) | ((worst == 0) & (np.arange(len(self.book))[None, :] > best[:, None]))
        return possible & ~behind


def _box_distances(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between points of two boxes, for all pairs of boxes."""
    above = other_low[None] - high[:, None]
    below = low[:, None] - other_high[None]
    gap = np.maximum(np.maximum(above, below), 0)
    reach = np.maximum(other_high[None] - low[:, None], high[:, None] - other_low[None])
    return (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)


def settled(tree: PartTree, entries: EntryTree) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """(level, nodes, entry of each) for nodes assigned whole; places in `order` of the other parts, and their entries."""
    whole = []
    nodes = np.zeros(1, dtype=np.int64)
    possible = np.ones((1, len(entries.book)), dtype=bool)
    for level in range(len(tree.low)):
        possible = entries.narrowed(tree.low[level][nodes], tree.high[level][nodes], possible)
        one = possible.sum(axis=1) == 1
        whole.append((level, nodes[one], possible[one].argmax(axis=1)))
        nodes, possible = nodes[~one], possible[~one]
        if level + 1 < len(tree.low):
            nodes = (2 * nodes[:, None] + np.arange(2)).ravel()
            possible = np.repeat(possible, 2, axis=0)
    first, last = tree.bounds(len(tree.low) - 1, nodes)
    sizes = last - first
    places = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    points = tree.points[places].astype(np.int64)
    distance = (entries.book * entries.book).sum(axis=1)[None, :] - 2 * (points @ entries.book.T)
    distance[~np.repeat(possible, sizes, axis=0)] = np.iinfo(np.int64).max
    return whole, places, distance.argmin(axis=1)


def _cuts(dimension: int) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end: equal ones, or the first ones longer by one."""
    edges = np.cumsum([0, *(len(p) for p in np.array_split(np.arange(dimension), PARTS))])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * component)."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * vectors), -MOST, MOST).astype(np.int32)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one dimension in chunks, with the trees of each."""
    held: dict[int, list[pa.RecordBatch]] = {}

    def chunk(dimension: int, rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = integers(flat.reshape(rows.num_rows, dimension))
        trees = pickle.dumps([PartTree.over(matrix[:, a:b]) for a, b in _cuts(dimension)])
        listed = [
            pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(c).combine_chunks()) for c in ("vec_id", "label")
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([dimension], pa.int32()), pa.array([trees], pa.binary()), *listed], ["dimension", "trees", "ids", "labels"]
        )

    for batch in batches:
        sizes = batch.column("dimension").to_numpy()
        for dimension in np.unique(sizes).tolist():
            own = held.setdefault(dimension, [])
            own.append(batch.filter(pa.array(sizes == dimension)))
            while sum(b.num_rows for b in own) >= CHUNK:
                rows = pa.Table.from_batches(own)
                yield chunk(dimension, rows.slice(0, CHUNK))
                own[:] = [b for b in rows.slice(CHUNK).to_batches() if b.num_rows]
    for dimension, own in held.items():
        if own:
            yield chunk(dimension, pa.Table.from_batches(own))


def _summed(batches: Iterator[pa.RecordBatch], books: dict[int, Books]) -> Iterator[pa.RecordBatch]:
    """For each entry the number of parts assigned to it, and their sums by place: once a task."""
    entries = {d: [EntryTree(b) for b in own] for d, own in books.items()}
    counts = {d: [np.zeros(len(b), dtype=np.int64) for b in own] for d, own in books.items()}
    sums = {d: [np.zeros(b.shape, dtype=np.int64) for b in own] for d, own in books.items()}
    seen = set()
    for batch in batches:
        for dimension, trees in zip(batch.column("dimension").to_pylist(), batch.column("trees")):
            seen.add(dimension)
            for position, tree in enumerate(pickle.loads(trees.as_py())):
                count, total = counts[dimension][position], sums[dimension][position]
                whole, places, nearest = settled(tree, entries[dimension][position])
                for level, nodes, entry in whole:
                    first, last = tree.bounds(level, nodes)
                    np.add.at(count, entry, last - first)
                    np.add.at(total, entry, tree.sums[level][nodes])
                np.add.at(count, nearest, 1)
                np.add.at(total, nearest, tree.points[places])
    for dimension in seen:
        for position, (count, total) in enumerate(zip(counts[dimension], sums[dimension])):
            used = np.flatnonzero(count).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dimension] * len(used), pa.int32()), pa.array([position] * len(used), pa.int32()), pa.array(used, pa.int32()),
                    pa.array([[int(count[e]), *total[e].tolist()] for e in used], pa.list_(pa.int64())),
                ],
                ["dimension", "part", "entry", "sums"],
            )


def _coded(batches: Iterator[pa.RecordBatch], books: dict[int, Books]) -> Iterator[pa.RecordBatch]:
    """Code and error of each vector."""
    entries = {d: [EntryTree(b) for b in own] for d, own in books.items()}
    for batch in batches:
        for row in range(batch.num_rows):
            dimension = batch.column("dimension")[row].as_py()
            ids, labels = (batch.column(c).slice(row, 1).flatten() for c in ("ids", "labels"))
            codes = np.zeros((len(ids), PARTS), dtype=np.uint8)
            errors = np.zeros(len(ids), dtype=np.int64)
            for position, tree in enumerate(pickle.loads(batch.column("trees")[row].as_py())):
                own = entries[dimension][position]
                whole, places, nearest = settled(tree, own)
                code = np.zeros(len(ids), dtype=np.int64)
                code[places] = nearest
                for level, nodes, entry in whole:
                    for first, last, e in zip(*tree.bounds(level, nodes), entry):
                        code[first:last] = e
                apart = tree.points - own.book[code]
                codes[tree.order, position] = code
                errors[tree.order] += (apart * apart).sum(axis=1)
            digest = books_digest(books[dimension])
            yield pa.RecordBatch.from_arrays(
                [
                    ids, labels, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors),
                    pa.array([dimension] * len(ids), pa.int32()), pa.array([digest] * len(ids), pa.string()),
                ],
                ["vec_id", "label", "code", "error", "dimension", "codebooks_sha256"],
            )


def books_digest(books: Books) -> str:
    """SHA-256 of all entries' components as decimal text, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def decoded(code: bytes, books: Books) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([book[c] for book, c in zip(books, code)])


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", *, rounds: int = ROUNDS
) -> tuple[DataFrame, dict[int, Books]]:
    """Codes of all usable vectors, and the codebooks by dimension.

    The codes have vec_id, label, code (binary, one byte a part), error (squared distance of the integer vector to what
    the code stands for), dimension and codebooks_sha256. Rows with a null vector or a null or non-finite component are
    dropped; zero vectors stay. Integers are floor(SCALE * component), held at MOST in magnitude. Vectors of one dimension
    have codebooks of their own; where it is no multiple of PARTS, the first parts are longer by one, and empty vectors have empty
    parts (code 0, error 0). A codebook starts from the first ENTRIES rows by vec_id (null last), then by components: all
    rows if there are fewer. Equal distances go to the lower entry, entries without a part stay as they were. Repeated
    rows count as often as they occur. Other columns are left out; an empty table gives no rows and no codebooks.
    """
    ship(vectors.sparkSession)
    vector = F.col(f"`{embedding}`").cast("array<double>")
    given = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), vector.alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = given.where(F.col("vector").isNotNull() & ~odd).withColumn("dimension", F.size("vector"))
    kind = given.schema["label"].dataType.simpleString()
    chunks = cut_lineage(rows.mapInArrow(_chunked, f"dimension int, trees binary, ids array<long>, labels array<{kind}>"))
    # Only the first rows of each dimension leave a task: Spark limits the groups before their shuffle.
    first = Window.partitionBy("dimension").orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    starts: dict[int, list] = {}
    for row in rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= ENTRIES).orderBy("rank").collect():
        starts.setdefault(row.dimension, []).append(row.vector)
    books: dict[int, Books] = {}
    for dimension, own in starts.items():
        matrix = integers(np.array(own, dtype=np.float64).reshape(len(own), dimension)).astype(np.int64)
        books[dimension] = [matrix[:, a:b].copy() for a, b in _cuts(dimension)]
    for _ in range(rounds if books else 0):
        summed = chunks.mapInArrow(partial(_summed, books=books), "dimension int, part int, entry int, sums array<long>")
        placed = summed.select("dimension", "part", "entry", F.posexplode("sums").alias("place", "amount"))
        totals = placed.groupBy("dimension", "part", "entry", "place").agg(F.sum("amount").alias("amount"))
        gathered = totals.groupBy("dimension", "part", "entry").agg(F.sort_array(F.collect_list(F.struct("place", "amount"))).alias("sums"))
        for row in gathered.collect():  # as many as there are entries
            count, *sums = (s.amount for s in row.sums)
            books[row.dimension][row.part][row.entry] = [s // count for s in sums]
    schema = f"vec_id long, label {kind}, code binary, error long, dimension int, codebooks_sha256 string"
    return chunks.mapInArrow(partial(_coded, books=books), schema), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with label_error, the sum of the errors of all rows of its label (null is a label; null beyond 64 bits)."""
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    sums = spread(sums).withColumnRenamed("label", "of_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def op11(spark: SparkSession, folder: str) -> DataFrame:
    coded, _ = compress(table(spark, folder, "embeddings"))
    found = with_label_errors(cut_lineage(coded))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def _oracle() -> str:
    floored = "(s - ((s % n) + n) % n) // n"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM kept, range({PARTS}) AS t(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {ENTRIES}),
book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN first USING (vec_id))"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, p, x, e, d FROM (
    SELECT vec_id, b.p AS p, x, e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)]) AS d
    FROM parts AS a JOIN book{i} AS b ON a.p = b.p)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)""")
        if i < ROUNDS:
            steps.append(f"""mean{i} AS (
  SELECT p, e, list({floored} ORDER BY j) AS c FROM (
    SELECT p, e, j, CAST(sum(x[j]) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
    FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS j FROM near{i}) GROUP BY p, e, j) GROUP BY p, e),
book{i + 1} AS MATERIALIZED (
  SELECT b.p AS p, b.e AS e, CAST(coalesce(m.c, b.c) AS BIGINT[]) AS c FROM book{i} AS b LEFT JOIN mean{i} AS m ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH {", ".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id),
labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN labels ON kept.label IS NOT DISTINCT FROM labels.label"""


ORACLE = _oracle()
