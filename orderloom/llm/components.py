"""Connected components of a links table, by alternating star contractions.

Every round is two joins and two aggregations over the links; no group is gathered. Links of
a node with very many neighbours are spread by adaptive skew joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import sized, staged


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that a node of `links` (a, b) is connected with.

    Nodes that are such a root themselves have no row.

    Links may come repeated, in either direction or from a node to itself; nodes are longs,
    null ends are left out. No links give no rows.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    )
    done, edges = False, staged(edges.distinct(), "links")
    rows = edges.count()  # no step makes more links
    while not done:  # the rounds grow with the square of the logarithm of the nodes
        done, edges = _round(edges, rows)
    return edges


def _round(edges: DataFrame, rows: int) -> tuple[bool, DataFrame]:
    """One large-star and one small-star step over at most `rows` links; done if every node
    points to a root.

    The least neighbours are written, so that both sides of the joins are plain shuffles,
    whose hot nodes adaptive execution can split.
    """
    both = edges.select(F.col("node").alias("n"), F.col("root").alias("m")).unionByName(
        edges.select(F.col("root").alias("n"), F.col("node").alias("m"))
    )
    least = staged(sized(both.groupBy("n").agg(F.least("n", F.min("m")).alias("low")), rows), "least")
    large = both.where("m > n").join(least, "n").select(F.col("m").alias("node"), F.col("low").alias("root"))
    large = staged(sized(sized(large, rows).distinct(), rows), "large-star")
    lowest = staged(sized(large.groupBy("node").agg(F.min("root").alias("low")), rows), "lowest")
    small = large.join(lowest, "node").select(
        F.when(F.col("root") == F.col("low"), F.col("node")).otherwise(F.col("root")).alias("node"),
        F.col("low").alias("root"),
    )
    small = staged(sized(sized(small, rows).distinct(), rows), "small-star")
    # A node with two roots, or one that is the root of others, is not settled.
    ends = small.select(F.col("node").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        small.select(F.col("root").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counts = sized(ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")), rows)
    return counts.where("up > 1 OR up > 0 AND down > 0").isEmpty(), small
