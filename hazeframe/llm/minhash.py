"""Near-duplicate documents: MinHash bands propose, sequential Bayesian tests prune, whole shingle sets decide.

Documents with the same set of shingles are one class, so that groups of copies cost one signature. Classes that share a
band are candidates. A pair's signatures are compared batch by batch; it is dropped as soon as the posterior probability
that its similarity reaches the threshold falls below `MISS`, or once a bitmap proves the sets too different. What
survives is checked on the whole sets.

Only which classes are connected is asked for, so a bucket isn't expanded into pairs: first its members meet its smallest
and largest member; once components are known, members of one component need not meet. While that leaves buckets of many
blocks, rounds over two bands each compare members within blocks dealt out by hash and keep a spanning forest of what they
find, so that large groups grow together at a cost in proportion to their size. What still holds several components then is
compared member by member, block against block, but for blocks of one and the same component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.llm.buckets import block_pairs_across, gathered, pairs_within, whole_groups
from hazeframe.llm.common import ROW, cut_lineage, id_and_text, slices, spread, table, without_rows, words_of
from hazeframe.llm.components import components

#: Words of a shingle; least similarity in hundredths.
WIDTH, LEAST = 3, 85
#: Bands, and hashes in each. At the threshold itself a pair shares no band with probability (1 - .85**5)**24 < 1e-6.
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
#: Hashes compared before each test, and the chance that a test loses a pair at the threshold.
BATCH, MISS = 24, 1e-6
#: Bits of the bitmap that holds, for each place, whether an odd number of shingles falls on it.
PLACES = 1024
#: Members of a block in a round that lets groups grow, and in the comparison of all that is left; bands of a round.
GROWING, BLOCK, BANDS_A_ROUND = 256, 1024, 2
#: What is kept of a set: hashes, bitmap, size.
SKETCH = np.dtype([("hashes", "<u4", HASHES), ("odd", "u1", PLACES // 8), ("size", "<u4")])

_WORD_KEYS = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Words whose hashes a worker remembers.
REMEMBERED = 500_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hash = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit hashes; all words as one shingle if there are fewer."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_word_hash.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    sums = np.full(len(words) - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        sums = _mixed(sums * _WORD_KEYS[0] + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(sums)


def _hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = _mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * _WORD_KEYS[1])
    low = (seeds & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return low[:count], low[count:] | np.uint32(1)


_XOR, _TIMES = _hash_family(HASHES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that isn't empty."""
    low = (_mixed(shingles) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(low), 1024):
        values = (low[start : start + 1024, None] ^ _XOR) * _TIMES
        values ^= values >> np.uint32(16)
        np.minimum(least, values.min(axis=0), out=least)
    return least


def least_matches(batch: int = BATCH, hashes: int = HASHES, least: float = LEAST / 100, miss: float = MISS) -> list[int]:
    """For each number of hashes seen (batch, 2 batch, ...), the matches below which a pair is dropped.

    With a uniform prior, m matches of n leave a Beta(m + 1, n - m + 1) similarity, and
    P(similarity >= t) = sum over j <= m of C(n + 1, j) t**j (1 - t)**(n + 1 - j).
    """
    bounds = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * least**m * (1 - least) ** (n + 1 - m)
        bounds.append(m)
    return bounds


BOUNDS = least_matches()


def sketch(shingles: np.ndarray) -> bytes:
    """SKETCH of a set that isn't empty."""
    odd = np.bincount((shingles >> np.uint64(50)).astype(np.int64) % PLACES, minlength=PLACES) & 1
    one = np.zeros(1, dtype=SKETCH)
    one["hashes"], one["odd"], one["size"] = signature(shingles), np.packbits(odd.astype(bool)), len(shingles)
    return one.tobytes()


def survivors(sketches: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (left, right) of sketches that no test drops.

    The places where two bitmaps differ are at most as many as the shingles that only one set has, and of a sum of sizes s
    at most (1 - t) / (1 + t) s may differ at a similarity t: a bound that never drops a link.
    """
    return _compared(sketches, left, right)[0]


def _compared(sketches: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Survivors, and how many hashes of each agree."""
    size = sketches["size"].astype(np.int64)
    low, high = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
    alive = np.flatnonzero(100 * low >= LEAST * high)
    seen = np.zeros(len(alive), dtype=np.int32)
    for step, bound in enumerate(BOUNDS):
        hashes = sketches["hashes"][:, step * BATCH : (step + 1) * BATCH]
        seen = seen + (hashes[left[alive]] == hashes[right[alive]]).sum(axis=1, dtype=np.int32)
        passed = seen >= bound
        alive, seen = alive[passed], seen[passed]
    apart = np.bitwise_count(sketches["odd"][left[alive]] ^ sketches["odd"][right[alive]]).sum(axis=1, dtype=np.int64)
    passed = (100 + LEAST) * apart <= (100 - LEAST) * (size[left[alive]] + size[right[alive]])
    return alive[passed], seen[passed]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(ROW), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
            ],
            [ROW, "doc_id", "n_shingles", "digest", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(sets, pa.binary())], ["node", "shingles"])


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=SKETCH)


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 4096):
        both = np.concatenate([_stack(batch.column("sketch_a")), _stack(batch.column("sketch_b"))])
        left = np.arange(batch.num_rows)
        yield batch.select(["a", "b"]).take(pa.array(survivors(both, left, left + batch.num_rows)))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets are similar enough."""
    for batch in slices(batches, 256):
        linked = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            left, right = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            shared = len(np.intersect1d(left, right, assume_unique=True))
            linked.append(100 * shared >= LEAST * (len(left) + len(right) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the groups, of different components, that no test drops."""
    for groups, group in whole_groups(batches, ["bucket", "pair"]):
        sketches = _stack(groups.column("sketch"))
        label, node = groups.column("component").to_numpy(), groups.column("node").to_numpy()
        for left, right in pairs_within(group, groups.column("own").to_numpy(), groups.column("same").to_numpy()):
            across = label[left] != label[right]
            left, right = left[across], right[across]
            for start in range(0, len(left), 20_000):
                a, b = left[start : start + 20_000], right[start : start + 20_000]
                alive = survivors(sketches, a, b)
                a, b = node[a[alive]], node[b[alive]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs of a block, of different components, that no test drops: a spanning forest, the closest pairs first."""
    for groups, group in whole_groups(batches, ["bucket", "own"]):
        sketches = _stack(groups.column("sketch"))
        label, node = groups.column("component").to_numpy(), groups.column("node").to_numpy()
        found = []
        everyone = np.ones(len(group), dtype=bool)
        for left, right in pairs_within(group, np.zeros(len(group), dtype=np.int64), everyone):
            across = label[left] != label[right]
            left, right = left[across], right[across]
            for start in range(0, len(left), 20_000):
                a, b = left[start : start + 20_000], right[start : start + 20_000]
                alive, seen = _compared(sketches, a, b)
                found.append(np.stack([a[alive], b[alive], seen]))
        if not found:
            continue
        a, b, seen = np.hstack(found)
        # Components of a block stand for themselves; blocks are apart, as a node is numbered by its row.
        _, start = np.unique(np.stack([group, label], axis=1), axis=0, return_inverse=True)
        root = list(range(int(start.max()) + 1))
        kept = []
        for i in np.argsort(-seen, kind="stable").tolist():
            x, y = int(start[a[i]]), int(start[b[i]])
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[x] = y
                kept.append(i)
        x, y = node[a[kept]], node[b[kept]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b), those that are similar enough on their whole sets."""
    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = first.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    return cut_lineage(both.select("a", "b", "set_a", "set_b").mapInArrow(_checked, "a long, b long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """ROW, doc_id, n_shingles, component_id, kept, group for each row of `docs`.

    Words stand between ASCII white space, A-Z lower-cased; a document's set are its distinct WIDTH-word shingles, or all
    its words if there are fewer. Documents whose sets have a similarity of LEAST hundredths or more are linked;
    component_id is the smallest doc_id that links reach (null only where all there are null), kept says whether it is
    the row's own. group is the component's own number, by ROW: two components have the same component_id where rows of
    different text repeat a doc_id. Null, empty and blank texts have no shingles, link with nothing and are kept, each its own component.
    Repeated rows link with each other. Shingles are compared as 64-bit hashes, sets of one class by a 128-bit digest.
    Pairs at the threshold are missed with a probability of about 1e-6 a pair by the bands, and 1e-6 a test.
    """
    rows = id_and_text(docs, doc_id, text, rows=True)
    schema = f"{ROW} long, doc_id long, n_shingles long, digest binary, sketch binary"
    sketched = cut_lineage(rows.mapInArrow(_sketches, schema))
    # A class's node is the first row that has its set; all rows of a class have the same sketch.
    classes = sketched.where("digest IS NOT NULL").groupBy("digest")
    classes = cut_lineage(classes.agg(F.min(ROW).alias("node"), F.min("doc_id").alias("first_id"), F.first("sketch").alias("sketch")))
    # A bucket's number ends in its band.
    band_keys = (F.xxhash64(F.lit(i), F.substring("sketch", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(BANDS))
    bands = F.array(*(F.shiftleft(key, 5).bitwiseOR(F.lit(i).cast("long")) for i, key in enumerate(band_keys)))
    members = classes.select("node", F.explode(bands).alias("bucket"))
    ends = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    # Sorted, so that Spark can split the members of a band that very many classes share.
    full = cut_lineage(members.join(spread(ends).hint("merge"), "bucket"))
    wanted = full.select(F.col("node").alias(ROW)).distinct()
    sets = cut_lineage(rows.select(ROW, "text").join(wanted, ROW).mapInArrow(_sets, "node long, shingles binary"))
    low = full.where("node > low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    high = full.where("node < high").select(F.col("node").alias("a"), F.col("high").alias("b"))
    pairs = low.unionByName(high).distinct()
    of = lambda end: classes.select(F.col("node").alias(end), F.col("sketch").alias(f"sketch_{end}"))
    paired = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sketch_a", "sketch_b")
    links = _linked(paired.mapInArrow(_tested, "a long, b long"), sets)
    labels = components(links, "a", "b")
    sketches = classes.select("node", "sketch")
    done = 0
    while True:
        # Buckets that still hold more than one component, with all their members.
        named = full.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
        named = cut_lineage(named)
        mixed = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
        mixed = cut_lineage(mixed.where("x < y").select("bucket", "n"))
        # Copies that the last comparison makes of members, if no component has blocks of its own.
        cost = mixed.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.ceil(F.col("n") / BLOCK)).alias("copies")).first()
        split = named.join(spread(mixed), "bucket")
        if not cost.n or cost.copies <= 2 * cost.n or done >= BANDS:
            break
        band = F.col("bucket").bitwiseAND(F.lit(31).cast("long"))
        own = F.pmod(F.xxhash64("node", F.lit(done)), F.ceil(F.col("n") / GROWING).cast("int")).alias("own")
        turn = split.where(band.between(done, done + BANDS_A_ROUND - 1)).select("bucket", "node", "component", own)
        met = gathered(turn.join(sketches, "node"), "bucket", "own").mapInArrow(_forest, "a long, b long").distinct()
        links = cut_lineage(links.unionByName(_linked(met, sets)))
        labels = components(links, "a", "b")
        done += BANDS_A_ROUND
    if cost.n:
        groups = block_pairs_across(split.drop("n"), "bucket", "node", "component", BLOCK).join(sketches, "node")
        across = gathered(groups, "bucket", "pair").mapInArrow(_across, "a long, b long").distinct()
        labels = components(links.unionByName(_linked(across, sets)), "a", "b")
    joined = classes.select("digest", "node", "first_id").join(labels, "node", "left")
    joined = joined.select("digest", "first_id", F.coalesce("component", "node").alias("component"))
    least = spread(joined.groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = joined.join(least, "component").select("digest", "component", "component_id")
    whole = sketched.drop("sketch").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select(
        ROW,
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("component", ROW).alias("group"),
    )


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop(ROW, "group")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: one document of each group stays, of rows that repeat its doc_id the first by ROW.

    Null, empty and blank texts are groups of their own and stay, as do all columns, whatever their names; an empty table
    stays empty.
    """
    found = cut_lineage(near_duplicates(docs).select(ROW, "kept", "group"))
    kept = found.where("kept").groupBy("group").agg(F.min(ROW).alias(ROW)).select(ROW)
    return without_rows(docs, found.select(ROW).join(kept, ROW, "left_anti"))
