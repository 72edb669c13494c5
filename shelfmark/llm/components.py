"""Connected components of a written table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import written


def _larger_to_least(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least node around it."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller_to_least(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """``u`` and the least node ``v`` of its component, for every linked node but the least itself.

    ``links`` has two columns of distinct comparable ids, u and v. Rounds are written to the shared
    folder and go on until one changes nothing; their number grows with the logarithm of the largest
    component. The driver sees a count and a checksum of each round.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    now = written(links.select(u.alias("u"), v.alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums[0] == 0 or tuple(sums) == state:
            return now
        state = tuple(sums)
        now = written(_smaller_to_least(_larger_to_least(now)), "links")
