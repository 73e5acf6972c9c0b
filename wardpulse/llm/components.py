"""Connected components of a link table, by alternating large and small stars.

Every round is two grouped minima and two joins over the links; nothing is
gathered on the driver but a link count and a checksum, and a hub's links are
spread by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardpulse.llm.rows import shared_table


def _checksum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame, max_rounds: int = 60, partial: bool = False) -> DataFrame:
    """Links (a, b) of longs -> (u, root): the smallest node reachable from each
    node ``u`` that is not itself the smallest.  Self links are ignored.

    ``partial``: stop after ``max_rounds``; the root of a node is then some
    smaller node that it reaches."""
    stars = shared_table(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"),
                                      F.least("a", "b").alias("v")).distinct(), "links")
    seen = _checksum(stars)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).distinct())
        stars = shared_table(small, "stars")
        if partial:
            continue
        now = _checksum(stars)
        if now == seen:
            break
        seen = now
    else:
        if not partial:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        stars = stars.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select("u", F.col("v").alias("root"))
