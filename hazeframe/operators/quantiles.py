"""Exact quantiles of whole columns, and of all groups of a table, without gathering a column or group in one task.

Spark's `percentile` merges a value -> count map of the entire group in a single task. Here three scans find the
values at the wanted ranks:

1. sketches, merged in two levels, give approximate quantiles a little below and above each probability;
2. these cut each column into a few segments, whose exact counts tell which segment holds which rank
   (the sketch only decides how narrow that segment is, never which value is returned);
3. the values of those segments alone are counted. A segment with more rows than one window should hold is stored and
   cut again in the same way, as often as needed, whatever the distribution of its values.

Nothing but sketches, segment counts and the narrow segments is ever shuffled. The first two steps run at once: sketches
are random, and numbers read back once stay the same for whatever is computed from them, also after a lost executor.
What the driver reads is a few numbers for each column and probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions.numeric import to_number
from hazeframe.session import cut_lineage

# Size of a sketch; ranks lie within MARGIN of the sketch's with a probability above 0.99.
SKETCH = 4096
MARGIN = 0.0015
# Groups of map tasks whose sketches are merged before those of all.
GROUPS = 1024
# Rows that one window sorts at most. It bounds memory; the answer doesn't depend on it.
WINDOW = 200_000
# Equal shares that a segment with more rows is cut into.
SHARES = 64


def _number(name: str) -> Column:
    return to_number(F.col(f"`{name.replace('`', '``')}`"))


def cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, value) of the present values; position is the index of the column."""
    values = F.array(*[_number(c) for c in columns])
    return df.select(F.posexplode(values).alias("position", "value")).where("value IS NOT NULL")


def column_at(columns: Sequence[str]) -> Column:
    """Column name of `position`."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("position") + 1)


def _edges(sketches: DataFrame, key: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """key, edges: ascending approximate quantiles at the fractions, from sketches of parts of each key's values."""
    whole = sketches.groupBy(*key).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    filled = whole.where(F.kll_sketch_get_n_double("sketch") > 0)
    at = F.array(*[F.lit(float(f)) for f in fractions])
    return filled.select(*key, F.array_sort(F.kll_sketch_get_quantile_double("sketch", at)).alias("edges"))


def _group() -> Column:
    return F.spark_partition_id() % GROUPS


def _column_edges(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> dict[int, list[float]]:
    """position -> edges. One sketch a column and task, no row is multiplied."""
    numbers = df.select(_group().alias("part"), *[_number(c).alias(f"v{i}") for i, c in enumerate(columns)])
    sketch = [F.kll_sketch_agg_double(f"v{i}", F.lit(SKETCH)).alias(f"v{i}") for i in range(len(columns))]
    parts = numbers.groupBy("part").agg(*sketch)
    long = parts.select(F.posexplode(F.array(*parts.columns[1:])).alias("position", "sketch"))
    return {row.position: row.edges for row in _edges(long.where("sketch IS NOT NULL"), ["position"], fractions).collect()}


def _counted(rows: DataFrame, key: Sequence[str], edges: Column, n: Column) -> DataFrame:
    """Rows, smallest and largest value of each key's segment; a value's segment is the number of edges below it."""
    segment = F.size(F.filter(edges, lambda e: e < F.col("value")))
    return rows.groupBy(*key, segment.alias("segment")).agg(
        F.sum(n).alias("n"), F.count(F.lit(1)).alias("n_values"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _first_reaching(rows: DataFrame, order: str, keep: Sequence[str]) -> DataFrame:
    """Per (position, rank): the first row in `order` whose running count passes the rank."""
    running = Window.partitionBy("position", "rank").orderBy(order)
    upto = rows.withColumn("upto", F.col("below") + F.sum("n").over(running))
    hit = (F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))
    return upto.where(hit).select("position", "rank", *keep, (F.col("upto") - F.col("n")).alias("below"))


HOLDER = "position int, rank long, low double, high double, n_values long, below long"


def _holders(found: DataFrame) -> DataFrame:
    """The segment that holds each rank, read back: one row per column and rank."""
    return found.sparkSession.createDataFrame(
        [tuple(row) for row in _first_reaching(found, "segment", ["low", "high", "n_values"]).collect()], HOLDER
    )


def _within(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """Values of the holders' segments with their number of rows."""
    key = ["position", "rank"] if "rank" in rows.columns else ["position"]
    kept = rows.join(F.broadcast(holders.drop("n_values")), key).where("value BETWEEN low AND high")
    return kept.select("position", "rank", "below", "value", *[c for c in ("n",) if c in rows.columns])


def _narrowed(inside: DataFrame, most: int) -> DataFrame:
    """`inside` cut down until no (position, rank) has more than `most` values."""
    key = ["position", "rank"]
    while True:
        inside = cut_lineage(inside)
        sizes = inside.groupBy(*key).agg(F.count(F.lit(1)).alias("n_values"))
        if not sizes.where(F.col("n_values") > most).head(1):
            return inside
        sketch = F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch")
        parts = inside.groupBy(*key, _group().alias("part")).agg(sketch)
        # As many rows as there are columns and probabilities, read back for the same reason as above.
        rows = _edges(parts, key, [i / SHARES for i in range(1, SHARES)]).collect()
        edges = inside.sparkSession.createDataFrame([tuple(r) for r in rows], "position int, rank long, edges array<double>")
        cut = _counted(inside.join(F.broadcast(edges), key), [*key, "below"], F.col("edges"), F.col("n"))
        inside = _within(inside.drop("below"), _holders(cut))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """(column, probability, value) by linear interpolation; columns without a value are absent."""
    values = cells(df, columns)
    around = sorted({min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-MARGIN, MARGIN)})
    found = _column_edges(df, columns, around)
    per_column = F.array(*[F.array(*[F.lit(e) for e in found.get(i, [])]).cast("array<double>") for i in range(len(columns))])
    counts = _counted(values, ["position"], F.element_at(per_column, F.col("position") + 1), F.lit(1))
    # A few numbers for each column and probability from here on to `holders`.
    segments = df.sparkSession.createDataFrame([tuple(row) for row in counts.collect()], counts.schema)
    place = (F.col("total") - 1) * F.col("probability")
    wanted = (
        segments.groupBy("position")
        .agg(F.sum("n").alias("total"))
        .withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .select(
            "position",
            "probability",
            F.floor(place).alias("lower_rank"),
            F.ceil(place).alias("upper_rank"),
            (place - F.floor(place)).alias("fraction"),
        )
    )
    ranks = wanted.select("position", F.explode(F.array("lower_rank", "upper_rank")).alias("rank")).distinct()
    start = segments.join(F.broadcast(ranks), "position").withColumn("below", F.lit(0).cast("bigint"))
    holders = _holders(start)
    inside = _within(values, holders).groupBy("position", "rank", "below", "value").agg(F.count(F.lit(1)).alias("n"))
    if holders.where(F.col("n_values") > WINDOW).head(1):
        inside = _narrowed(inside, WINDOW)
    reached = _first_reaching(inside, "value", ["value"])
    # Broadcast: a row per column and rank.
    ends = wanted.join(F.broadcast(reached), "position").where("rank IN (lower_rank, upper_rank)")
    lower = F.max(F.when(F.col("rank") == F.col("lower_rank"), F.col("value")))
    upper = F.max(F.when(F.col("rank") == F.col("upper_rank"), F.col("value")))
    return (
        ends.groupBy("position", "probability", "fraction")
        .agg((lower + (upper - lower) * F.col("fraction")).alias("value"))
        .select(column_at(columns).alias("column"), "probability", "value")
    )


def quantile_table(quantiles: DataFrame, names: dict[float, str]) -> DataFrame:
    """One row per column, one field per probability."""
    fields = [
        F.max(F.when(F.col("probability") == F.lit(float(p)), F.col("value"))).alias(name)
        for p, name in names.items()
    ]
    return quantiles.groupBy("column").agg(*fields)


def spread_out(df: DataFrame) -> DataFrame:
    """A table of one row a group, dealt out anew, so that a join shuffles both sides and Spark can split a large group."""
    return df.hint("rebalance")


def quantiles_by_group(
    df: DataFrame, by: Sequence[str], column: str, probabilities: Sequence[float], most: int = WINDOW
) -> DataFrame:
    """by, probability, value: exact quantiles of a column in every group, by linear interpolation.

    Equal values are counted first, by group and value, so that a group of any size is spread over tasks by its values. A group with
    more than `most` distinct ones is cut into shares by a sketch, merged in two levels; counts tell which shares hold the wanted
    ranks, and these are cut again until one window holds each. All groups are cut at once and nothing is read by the driver.
    Rows without a group or value don't count; groups without a value are absent.
    """
    by = list(by)
    numbers = df.select(*by, _number(column).alias("value")).na.drop()
    rows = numbers.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows.withColumns({"segment": F.lit("").cast("string"), "below": F.lit(0).cast("bigint")}))
    place = (F.col("total") - 1) * F.col("probability")
    wanted = (
        rows.groupBy(*by)
        .agg(F.sum("n").alias("total"))
        .withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .select(*by, "probability", F.floor(place).alias("lower_rank"), F.ceil(place).alias("upper_rank"), (place - F.floor(place)).alias("fraction"))
    )
    # One row a group: the ranks it is asked for.
    pair = F.array(F.col("lower_rank"), F.col("upper_rank"))
    ranks = wanted.groupBy(*by).agg(F.array_distinct(F.flatten(F.collect_list(pair))).alias("ranks"))
    key = [*by, "segment"]
    while True:
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_values"))
        large = cut_lineage(sizes.where(F.col("n_values") > most).select(*key))
        if large.isEmpty():
            break
        small = rows.join(spread_out(large), key, "left_anti")
        inside = rows.join(spread_out(large), key)
        sketch = F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch")
        parts = inside.groupBy(*key, _group().alias("part")).agg(sketch)
        # Sketches are random: what they say is stored, so that every reader sees the same shares.
        edges = cut_lineage(_edges(parts, key, [i / SHARES for i in range(1, SHARES)]))
        share = F.size(F.filter("edges", lambda e: e < F.col("value")))
        inside = inside.join(spread_out(edges), key).withColumn("share", share).drop("edges")
        counts = inside.groupBy(*key, "below", "share").agg(F.sum("n").alias("m"))
        running = F.sum("m").over(Window.partitionBy(*key).orderBy("share")) - F.col("m")
        held = counts.withColumn("under", F.col("below") + running).join(spread_out(ranks), by)
        held = held.where(F.exists("ranks", lambda r: (r >= F.col("under")) & (r < F.col("under") + F.col("m"))))
        inside = inside.drop("below").join(spread_out(held.select(*key, "share", F.col("under").alias("below"))), [*key, "share"])
        inside = inside.withColumn("segment", F.concat_ws(".", "segment", F.col("share").cast("string")))
        rows = cut_lineage(small.select(*rows.columns).unionByName(inside.select(*rows.columns)))
    upto = rows.withColumn("upto", F.col("below") + F.sum("n").over(Window.partitionBy(*key).orderBy("value")))
    hits = F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    reached = upto.join(spread_out(ranks), by).select(*by, "value", F.explode(hits).alias("rank"))
    ends = wanted.join(reached, by).where("rank IN (lower_rank, upper_rank)")
    lower = F.max(F.when(F.col("rank") == F.col("lower_rank"), F.col("value")))
    upper = F.max(F.when(F.col("rank") == F.col("upper_rank"), F.col("value")))
    return (
        ends.groupBy(*by, "probability", "fraction")
        .agg((lower + (upper - lower) * F.col("fraction")).alias("value"))
        .select(*by, "probability", "value")
    )
