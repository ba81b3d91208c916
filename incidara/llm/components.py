"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star round: each node hands its least neighbour to the others it sees."""
    if large:
        seen = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = seen.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter("u <> v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """The least node reachable from each node of ``pairs`` (u long, v long).

    Returns node, root for every node that has a partner. Rounds are written to
    the shared folder, so a lost executor costs the round at hand. The number
    of rounds is logarithmic in the longest chain; the minima fold before they
    are shuffled, and a hub's rows are split by the adaptive skew join. No
    pairs, no rows.
    """
    pairs = stage(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "pairs")
    mark = None
    while True:
        digest = pairs.agg(
            F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
        ).first()
        if digest == mark:
            break
        mark = digest
        pairs = stage(_star(_star(pairs, True), False), "stars")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
