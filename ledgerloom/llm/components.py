"""Connected components of links between nodes, as a loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import settle


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every linked node but the roots the smallest node it is connected to.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its smallest one, then
    its smaller ones. The number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder; the driver sees a count and a checksum. Neighbours are never gathered in one
    row, and groups are pre-aggregated to their minimum before they shuffle.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pairs, state = settle(pairs, "components"), None
    while True:
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())
        if now == state or not now[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(pairs.select("u", "v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = settle(small.distinct(), "components")
