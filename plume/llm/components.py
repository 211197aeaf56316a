"""Connected components of an edge table by alternating star contraction.

Each round is two aggregate-and-join steps; the edge table never leaves the
executors and its lineage is cut in the shared checkpoint folder every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import cut


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.xxhash64("u", "v") % F.lit(1 << 31)), F.lit(0)).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").filter("v != m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link table with bigint ends ``a``,
    ``b``; root is the smallest node of the component.

    Self links and links with a null end are ignored; an empty table gives an
    empty result.  Repeated and reversed links are one link.  Rounds needed
    grow with the logarithm of a component's diameter; the loop ends when a
    round changes nothing.
    """
    links = cut(edges.filter(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _signature(links)
    while seen[0]:
        links = cut(_small_star(_large_star(links)))
        now = _signature(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
