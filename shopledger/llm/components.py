"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import written


def _least(links: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours; partial sums keep hubs from gathering in a task."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root (the smallest node it can reach) for all nodes of links (u, v) but the roots.

    Links may be in any direction and repeated. Each round is written to the shared folder. A
    round makes every node's larger (smaller) neighbours point to its smallest one; the
    number of rounds grows with the logarithm of the longest path.
    """
    now = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    now, before = written(now, name), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        ways = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            ways.join(_least(ways), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        )
        # here u > v in every row
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(least.select("u", F.col("m").alias("v")))
        now = written(small.distinct(), name)
