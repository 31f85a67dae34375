"""Comparing the members of candidate buckets with each other, however large a bucket is.

A bucket is cut into blocks of bounded size; each pair of blocks is a group of its own, which a task compares in memory.
Nothing is emitted for a pair of members but what the comparison finds, and no bucket is cut short.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.llm.common import spread

#: Members of a block. A group holds at most two blocks, apart from the chance of uneven hashing.
BLOCK = 256


def block_pairs(members: DataFrame, key: str, member: str, block: int | None = None) -> DataFrame:
    """`members` of the buckets with two or more, once for each group they belong to, with two more columns.

    `own` is a member's block, `pair` the group's two blocks as one number: members of the two meet there, or those of
    one block with each other where `same`. (key, pair) is the group. Members must be distinct in a bucket.
    """
    block = block or BLOCK
    sizes = members.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    sized = members.join(spread(sizes), key)
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    wide = F.col("blocks").cast("long")
    return (
        sized.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(others))
        .withColumn("pair", F.least("own", "other") * wide + F.greatest("own", "other"))
        .withColumn("same", F.col("own") == F.col("other"))
        .drop("n", "blocks", "other")
    )


def block_pairs_across(members: DataFrame, key: str, member: str, label: str, block: int | None = None) -> DataFrame:
    """As `block_pairs`, for comparisons of members with different labels only, in buckets that hold several labels.

    A label with more than half a block of a bucket's members has blocks of its own there, which don't meet each other;
    the rest of the bucket is dealt out by hash. A large label beside a few others is copied once for each of their blocks.
    """
    block = block or BLOCK
    sizes = members.groupBy(key, label).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("mine", F.when(F.col("n") > block // 2, F.col(label)))
    # One row for each label with blocks of its own and one for the rest: few, however large the bucket.
    shares = sizes.groupBy(key, "mine").agg(F.sum("n").alias("n"), F.count("*").alias("labels"))
    shares = shares.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    in_order = Window.partitionBy(key).orderBy(F.col("mine").asc_nulls_first())
    all_of = Window.partitionBy(key)
    shares = shares.withColumns(
        {
            "base": (F.sum("blocks").over(in_order) - F.col("blocks")).cast("int"),
            "total": F.sum("blocks").over(all_of).cast("int"),
            "several": F.sum("labels").over(all_of) > 1,
        }
    ).where("several")
    own_share = shares.where("mine IS NOT NULL").select(key, F.col("mine").alias(label), "base", "blocks", "total")
    rest_share = shares.where("mine IS NULL").select(key, *(F.col(c).alias(f"rest_{c}") for c in ("base", "blocks", "total")))
    placed = members.join(spread(own_share), [key, label], "left").join(spread(rest_share), key, "left")
    apart = F.col("total").isNotNull()
    for name in ("base", "blocks", "total"):
        placed = placed.withColumn(f"rest_{name}", F.coalesce(name, f"rest_{name}"))
    base, blocks, total = (F.col(f"rest_{name}") for name in ("base", "blocks", "total"))
    own = base + F.pmod(F.xxhash64(member), blocks).cast("int")
    others = F.sequence(F.lit(0), total - 1)
    others = F.when(apart, F.filter(others, lambda x: (x < base) | (x >= base + blocks))).otherwise(others)
    wide = total.cast("long")
    return (
        placed.where(total.isNotNull())
        .select("*", own.alias("own"), F.explode(others).alias("other"))
        .withColumn("pair", F.least("own", "other") * wide + F.greatest("own", "other"))
        .withColumn("same", F.col("own") == F.col("other"))
        .select(*members.columns, "own", "pair", "same")
    )


def gathered(grouped: DataFrame, *key: str) -> DataFrame:
    """The same rows with those of a group in one task, one after the other, for `whole_groups`."""
    return grouped.repartition(*key).sortWithinPartitions(*key)


def whole_groups(batches: Iterable[pa.RecordBatch], key: list[str], most: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups only, some `most` rows or one group, and the number of each row's group there."""
    held: pa.Table | None = None

    def cut(table: pa.Table) -> np.ndarray:
        """The first rows of groups."""
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for name in key:
            column = table.column(name).combine_chunks()
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, table.num_rows - 1)).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    for batch in batches:
        piece = pa.Table.from_batches([batch])
        held = piece if held is None else pa.concat_tables([held, piece])
        if held.num_rows < most:
            continue
        starts = cut(held)
        if len(starts) > 1:
            last = int(starts[-1])
            whole = held.slice(0, last)
            yield whole, np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            held = held.slice(last)
    if held is not None and held.num_rows:
        starts = cut(held)
        yield held, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, held.num_rows)))


def pairs_within(group: np.ndarray, own: np.ndarray, same: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (left, right) of all pairs to compare, some at a time: of one group, and of its two blocks one each, or
    of its one block both (`same`)."""
    ends = np.searchsorted(group, group, side="right")
    left = np.arange(len(group))
    step, ready, count = 0, [], 0
    while len(left):
        step += 1
        left = left[ends[left] > left + step]
        right = left + step
        meet = same[left] | (own[left] != own[right])
        ready.append((left[meet], right[meet]))
        count += int(meet.sum())
        if count > 200_000 or not len(left):
            yield np.concatenate([a for a, _ in ready]), np.concatenate([b for _, b in ready])
            ready, count = [], 0
