"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is a fixed number of joins and aggregations over the links and ends in a written
table; the rounds needed grow with the logarithm of the longest chain. Minima are combined
before the shuffle, and the table of minima is written before it is joined, so that the
join stands on two plain shuffles and Spark can split a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of a link, the smallest node it can reach. Links are
    undirected; loops, repeats and null ends have no effect; no links, no rows."""
    x, y = F.col(a), F.col(b)
    stars = written(links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    before = _state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        after = _state(stars)
        if after == before:
            break
        before = after
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
