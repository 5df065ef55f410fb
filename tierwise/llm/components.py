"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and joins over the links; nothing is collected
but a count and a checksum. The star form turns each component into one centre
(its smallest node) with a link from every other node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.scratch import Scratch


#: Number of links and a checksum of them, to see when a round changes nothing.
CHECKSUM = ["count(1)", "bit_xor(xxhash64(u, v))"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("low").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` has u > v in every row."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    moved = (links.join(low, "u").where("v > low")
             .select(F.col("v").alias("u"), F.col("low").alias("v")))
    return moved.union(low.select("u", F.col("low").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) links of any direction -> (node, centre) for every linked node.

    The centre is the smallest node of the component and has a row itself. No
    links give no rows; self links and repeated links change nothing.
    """
    now, seen = scratch.save_observed(
        links.where("u is not null and v is not null and u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links", CHECKSUM)
    while seen[0]:
        last = seen
        now, seen = scratch.save_observed(_small_star(_large_star(now)), "star", CHECKSUM)
        if last == seen:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("centre"))
            .union(now.select("v", "v").distinct()))
