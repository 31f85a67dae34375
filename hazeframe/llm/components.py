"""Connected components of an edge table: alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is an aggregation and a join on a node. The minima are dealt out anew before the join, so that Spark may split
the rows of a node with very many edges over several tasks; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.common import cut_lineage, spread


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for each node that has an edge to another one; component is the smallest node it reaches.

    Node values may be of any orderable type. Repeated edges, loops and nulls (no edge) are allowed; without edges the
    result is empty.
    """
    a, b = F.col(left), F.col(right)
    links = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = cut_lineage(links)
    while not _stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        minima = spread(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.join(minima, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        minima = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(spread(minima), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut_lineage(small.unionByName(minima.select("u", F.col("m").alias("v"))).distinct())
    roots = links.select(F.col("v").alias("u"), "v").distinct()
    return links.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(links: DataFrame) -> bool:
    """Whether each node that points points to one root, and no root points on."""
    one, no = F.lit(1), F.lit(0)
    ends = links.select(F.col("u").alias("n"), one.alias("out"), no.alias("hit")).unionByName(
        links.select(F.col("v").alias("n"), no.alias("out"), one.alias("hit"))
    )
    seen = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("hit").alias("hit"))
    return seen.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("hit") == 1))).isEmpty()
