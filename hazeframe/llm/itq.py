"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, and cosines of the original vectors.

Rotations learned on a bounded sample turn each vector into balanced binary codes. Each table indexes a part of the code:
a vector stands under its part and under each part one bit away, so that two vectors meet if their parts differ in at most
two bits. Of the tables and keys where a pair meets, one is its own; there, if the whole codes are near enough, the cosine
is computed in double precision. Links are counted where they are found, and only a spanning set of them leaves a task.
Equal vectors are one entry of the index, with their number, so that copies cost what one vector costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.buckets import block_pairs, gathered, pairs_within, whole_groups
from hazeframe.llm.common import ROW, cut_lineage, ship, spread, table
from hazeframe.llm.components import components

LEAST = 0.9
#: Vectors on which the rotations are learned, and the rounds of learning.
SAMPLE, ROUNDS = 5_000, 30
#: Rotations at least, tables for each, and bits of a table's key at most. For vectors of mean zero a bit differs at a
#: cosine of 0.9 with probability acos(0.9) / pi = 0.144, so that a table holds a pair within two bits with probability
#: 0.40, and six tables with 0.95. A direction that all vectors share makes centred pairs differ in more bits: `Codes`
#: adds rotations, up to MOST_ROTATIONS, then shortens the keys, to LEAST_BITS, until RECALL of the pairs at the threshold meet.
#: Where centring takes pairs apart (a few vectors around their mean lie on opposite sides of it), it tries without a centre before it
#: shortens the keys. With the shortest keys it adds rotations up to ROTATIONS_AT_LAST, and stays below RECALL if that is not enough.
ROTATIONS, PARTS, BITS, MOST_ROTATIONS = 2, 3, 21, 16
LEAST_BITS, ROTATIONS_AT_LAST = 15, 48
#: Share of pairs at the threshold that must meet, of each kind of `threshold_pairs`, and pairs of each kind for it.
RECALL, PAIRS = 0.95, 4_000
#: Whole codes of a linked pair may differ in as many bits as this many deviations above the mean over pairs at the
#: threshold, and in this share of the bits at least.
DEVIATIONS, MOST_SHARE = 4.5, 36 / 126


def learn_rotation(centred: np.ndarray, bits: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """A projection (dimension x bits): the leading principal directions, turned so that signs lose least (Gong and
    Lazebnik, 2011). Directions are added at random where a sample has fewer dimensions than bits."""
    random = np.random.Generator(np.random.PCG64(seed))
    _, vectors = np.linalg.eigh(centred.T @ centred)
    basis = vectors[:, ::-1][:, :bits]
    if basis.shape[1] < bits:
        basis = np.hstack([basis, random.standard_normal((centred.shape[1], bits - basis.shape[1]))])
    projected = centred @ basis
    turn, _ = np.linalg.qr(random.standard_normal((bits, bits)))
    for _ in range(rounds):
        codes = np.where(projected @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ projected)
        turn = (left @ right).T
    return basis @ turn


def threshold_pairs(unit: np.ndarray, least: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors whose cosine is `least`, by kind: vectors of the sample moved in any direction, moved towards
    another one, pairs of its own at `least` or above, and, where the sample has a hundred, those just above it."""
    random = np.random.Generator(np.random.PCG64(ROTATIONS))
    left = unit[random.integers(len(unit), size=PAIRS)]
    kinds = []
    for towards in (random.standard_normal(left.shape), unit[random.integers(len(unit), size=PAIRS)]):
        across = towards - np.einsum("ij,ij->i", towards, left)[:, None] * left
        length = np.linalg.norm(across, axis=1)
        some = length > 1e-6
        across = across[some] / length[some, None]
        kinds.append((left[some], least * left[some] + np.sqrt(max(0.0, 1 - least * least)) * across))
    block = 500
    for most, enough in ((2.0, 1), (least + (1 - least) / 5, 100)):
        found = []
        for start in range(0, len(unit), block):
            cosine = np.triu(unit[start : start + block] @ unit.T, start + 1)
            i, j = np.nonzero((cosine >= least) & (cosine < most))
            chosen = random.permutation(len(i))[: PAIRS * block // len(unit) + 1]
            found.append(np.stack([i[chosen] + start, j[chosen]]))
        i, j = np.hstack(found)
        if len(i) >= enough:
            kinds.append((unit[i], unit[j]))
    return [kind for kind in kinds if len(kind[0])]


class Codes:
    """Rotations and centre as learned; `of` gives the codes, one number of PARTS * `bits` bits for each rotation.

    There are as many rotations, and keys as short, as RECALL asks for. Keys never have less than LEAST_BITS: with much shorter
    ones nearly all pairs would meet. `recall` is the share of pairs at the threshold that met in the end, and
    `most` the number of bits in which the whole codes of a linked pair may differ.
    """

    def __init__(self, sample: np.ndarray, least: float = LEAST):
        pairs = threshold_pairs(sample, least)
        mean = sample.mean(axis=0)
        for self.bits in range(BITS, LEAST_BITS - 1, -3):
            for self.centre in (mean, np.zeros_like(mean)):
                self.rotations: list[np.ndarray] = []
                while len(self.rotations) < (MOST_ROTATIONS if self.bits > LEAST_BITS else ROTATIONS_AT_LAST):
                    self.rotations.append(learn_rotation(sample - self.centre, PARTS * self.bits, len(self.rotations)))
                    self.recall = self._measure(pairs)
                    if len(self.rotations) >= ROTATIONS and self.recall >= RECALL:
                        return

    def _measure(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> float:
        """The share of pairs that the index finds, of the kind where it is least; sets `most` for all kinds."""
        apart = [self.of(left) ^ self.of(right) for left, right in pairs]
        whole = [np.bitwise_count(a).sum(axis=1) for a in apart]
        least = int(MOST_SHARE * self.tables * self.bits)
        self.most = max([least, *(int(np.ceil(w.mean() + DEVIATIONS * w.std())) for w in whole)])
        met = [(_parts_apart(a, self.bits) <= 2).any(axis=1) & (w <= self.most) for a, w in zip(apart, whole)]
        return min((float(m.mean()) for m in met), default=1.0)

    @property
    def tables(self) -> int:
        return PARTS * len(self.rotations)

    def of(self, unit: np.ndarray) -> np.ndarray:
        weights = 1 << np.arange(PARTS * self.bits, dtype=np.int64)
        return np.stack([((unit - self.centre) @ rotation >= 0) @ weights for rotation in self.rotations], axis=1)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """ROW, vec_id, vector (double[]) and whether it is one that can link: not null, zero, or with odd components."""
    ship(vectors.sparkSession)
    given = vectors.select(
        F.monotonically_increasing_id().alias(ROW),
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{embedding}`").cast("array<double>").alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return given.withColumn("fit", F.coalesce(some & ~odd, F.lit(False)))


def _matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return values.reshape(len(column), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or very small components would overflow or vanish.
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _coded(batches: Iterator[pa.RecordBatch], codes: Codes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            parts = codes.of(_unit(_matrix(batch.column("vector"))))
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(parts.tolist(), pa.list_(pa.int64()))], [ROW, "code"])


def _own_pairs(code: np.ndarray, left: np.ndarray, right: np.ndarray, number: np.ndarray, key: np.ndarray, bits: int, most: int) -> np.ndarray:
    """Which pairs of rows are near over the whole codes and have the table and key of their group as their own.

    A pair's own table is the first in which its parts differ in at most two bits; its own key there is the smallest
    under which both stand: the part itself, the smaller part, or the smaller of the two parts between them.
    """
    apart = code[left] ^ code[right]
    near = np.bitwise_count(apart).sum(axis=1) <= most
    left, right, apart = left[near], right[near], apart[near]
    here = _part_of(apart, number[left], bits)
    mine, other = _part_of(code[left], number[left], bits), _part_of(code[right], number[left], bits)
    count, lowest = np.bitwise_count(here), here & -here
    between = np.minimum(mine ^ lowest, mine ^ here ^ lowest)
    smallest = np.where(count == 0, mine, np.where(count == 1, np.minimum(mine, other), between))
    own = (np.argmax(_parts_apart(apart, bits) <= 2, axis=1) == number[left]) & (smallest == key[left])
    return np.flatnonzero(near)[own]


def _parts_apart(apart: np.ndarray, bits: int) -> np.ndarray:
    """Bits that are set in each table's part."""
    return np.stack([np.bitwise_count(_part(apart, t, bits)) for t in range(PARTS * apart.shape[1])], axis=1)


def _part(code: np.ndarray, table: int, bits: int) -> np.ndarray:
    return (code[:, table // PARTS] >> (table % PARTS * bits)) & ((1 << bits) - 1)


def _part_of(code: np.ndarray, tables: np.ndarray, bits: int) -> np.ndarray:
    chosen = np.take_along_axis(code, (tables // PARTS)[:, None], axis=1)[:, 0]
    return (chosen >> (tables % PARTS * bits)) & ((1 << bits) - 1)


def _candidates(groups: pa.Table, group: np.ndarray, bits: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs that are candidates and have their group as their own."""
    code = _matrix(groups.column("code").combine_chunks(), np.int64)
    bucket = groups.column("bucket").to_numpy()
    number, key = bucket >> bits, bucket & ((1 << bits) - 1)
    for left, right in pairs_within(group, groups.column("own").to_numpy(), groups.column("same").to_numpy()):
        own = _own_pairs(code, left, right, number, key, bits, most)
        yield left[own], right[own]


def _meeting(batches: Iterator[pa.RecordBatch], bits: int, most: int) -> Iterator[pa.RecordBatch]:
    """The members of groups that have a candidate there."""
    for groups, group in whole_groups(batches, ["bucket", "pair"]):
        met = np.zeros(groups.num_rows, dtype=bool)
        for left, right in _candidates(groups, group, bits, most):
            met[left] = True
            met[right] = True
        yield from groups.filter(pa.array(met)).select(["bucket", "pair", "own", "same", "code", ROW]).to_batches()


def _reranked(batches: Iterator[pa.RecordBatch], least: float, bits: int, most: int) -> Iterator[pa.RecordBatch]:
    """Links of the groups' own pairs: the rows that each member links to, and another member to which links lead."""
    for groups, group in whole_groups(batches, ["bucket", "pair"], 2048):
        unit = _unit(_matrix(groups.column("vector").combine_chunks()))
        rows_of = groups.column("copies").to_numpy()
        counts, ends = np.zeros(groups.num_rows, dtype=np.int64), []
        for left, right in _candidates(groups, group, bits, most):
            linked = np.einsum("ij,ij->i", unit[left], unit[right]) >= least
            ends.append((left[linked], right[linked]))
            np.add.at(counts, left[linked], rows_of[right[linked]])
            np.add.at(counts, right[linked], rows_of[left[linked]])
        left, right = (np.concatenate([e[i] for e in ends]) for i in (0, 1))
        root = np.arange(groups.num_rows)
        while True:
            least_root = np.minimum(root[left], root[right])
            before = root.copy()
            np.minimum.at(root, left, least_root)
            np.minimum.at(root, right, least_root)
            root = root[root]
            if (root == before).all():
                break
        some = np.flatnonzero(counts)
        rows = groups.column(ROW).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[some]), pa.array(counts[some]), pa.array(rows[root[some]])], [ROW, "links", "other"]
        )


def _buckets(code: str, tables: int, bits: int) -> Column:
    """For each table the part of a code, and that part with one bit changed, as (table << bits) + key."""
    changes = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(bits)))

    def keys(table: int) -> Column:
        part = F.shiftright(F.col(code)[table // PARTS], table % PARTS * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        return F.transform(changes, lambda change: F.lit(table << bits).cast("long") + part.bitwiseXOR(change))

    return F.flatten(F.array(*(keys(t) for t in range(tables))))


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", *, least: float = LEAST, sample: int = SAMPLE
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of `vectors`.

    Vectors link if their cosine, in double precision, is `least` or more and the index finds the pair (see ROTATIONS and RECALL);
    none below it is linked. n_links counts the other rows linked directly, rows that repeat a vector included;
    component_id is the smallest vec_id that links reach, the row's own included; kept says whether it is the row's own.
    Null vectors, zero vectors and those with a null or non-finite component link with nothing and are kept. Vectors
    link with those of their own dimension only. The rotations are learned on at most `sample` distinct vectors of a dimension, chosen
    by hash. Other columns, whatever their names, are left out; an empty table gives no rows.
    """
    rows = usable(vectors, vec_id, embedding)
    rows = rows.withColumn("hash", F.when(F.col("fit"), F.xxhash64("vector")))
    # Equal vectors are one entry, numbered by its first row.
    fit = rows.where("fit").groupBy("hash", "vector").agg(F.min(ROW).alias("node"), F.count("*").alias("copies"))
    fit = cut_lineage(fit.withColumn("dimension", F.size("vector")))
    found = None
    for row in fit.select("dimension").distinct().orderBy("dimension").collect():
        own = fit.where(F.col("dimension") == row.dimension).select(F.col("node").alias(ROW), "hash", "vector", "copies")
        part = _links(own, least, sample)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    placed = rows.select(ROW, "vec_id", "hash", "vector").join(spread(fit.select("hash", "vector", "node", "copies")), ["hash", "vector"], "left")
    placed = placed.select(ROW, "vec_id", F.coalesce("node", ROW).alias("node"), F.coalesce("copies", F.lit(1)).alias("copies"))
    if found is None:
        linked = placed.select(ROW, "vec_id", F.col("node").alias("component"), (F.col("copies") - 1).alias("n_links"))
    else:
        counts = spread(found.groupBy(F.col(ROW).alias("node")).agg(F.sum("links").alias("links")))
        linked = placed.join(spread(components(found, ROW, "other")), "node", "left").join(counts, "node", "left")
        all_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
        linked = linked.select(ROW, "vec_id", F.coalesce("component", "node").alias("component"), all_links.alias("n_links"))
    smallest = spread(linked.groupBy("component").agg(F.min("vec_id").alias("component_id")))
    return linked.join(smallest, "component").select(
        "vec_id",
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _links(fit: DataFrame, least: float, sample: int) -> DataFrame | None:
    """ROW, links, other of distinct vectors of one dimension (ROW, hash, vector, copies); None with fewer than two."""
    chosen = fit.orderBy("hash", "vector").limit(sample).select("vector").toPandas()
    if len(chosen) < 2:
        return None
    codes = Codes(_unit(np.stack(chosen["vector"])), least)
    near = {"bits": codes.bits, "most": codes.most}
    vectors = fit.select(ROW, "vector", "copies")
    coded = cut_lineage(fit.select(ROW, "vector").mapInArrow(partial(_coded, codes=codes), f"{ROW} long, code array<long>"))
    members = coded.select(ROW, F.explode(_buckets("code", codes.tables, codes.bits)).alias("bucket"))
    parted = gathered(block_pairs(members, "bucket", ROW).join(coded, ROW), "bucket", "pair")
    met = parted.mapInArrow(partial(_meeting, **near), f"bucket long, pair long, own int, same boolean, code array<long>, {ROW} long")
    met = gathered(met.join(vectors, ROW), "bucket", "pair")
    return cut_lineage(met.mapInArrow(partial(_reranked, least=least, **near), f"{ROW} long, links long, other long"))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))
