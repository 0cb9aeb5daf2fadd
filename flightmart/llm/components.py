"""Connected components over a table of links, by alternating star steps.

Every round points the larger neighbours of each node at its smallest
neighbour, then the smaller ones too, until the links are stars around the
smallest id of each component.  A round is two grouped minima and joins, so a
hub with a third of all links is pre-aggregated and its join can be split;
rounds are written to the shared folder and grow with the logarithm of the
largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stored


def _star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    large = large.union(low.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return small.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; the component is the
    smallest node that can be reached.  ``edges``: two columns of node ids."""
    a, b = edges.columns
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    state = None
    while True:
        now = stored(_star(now), "stars")
        after = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == state or not after[0]:
            break
        state = after
    centre = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centre.select("node", F.col("node").alias("component")))
