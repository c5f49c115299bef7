"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for each end of
    ``edges`` (columns ``a`` and ``b``, longs).

    Large star: every node links its larger neighbours to its smallest; small
    star: every node links its smaller neighbours to their smallest.  Both keep
    what is connected, and they end in stars around the smallest nodes after a few
    rounds.  Each round is two aggregations and two joins; its result is written to
    the shared folder, so lineage stays short."""
    now = stage(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct())
    state = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select("v", F.col("m").alias("u")).filter("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = stage(small.select("e.v", F.col("e.m").alias("u")).filter("u < v").distinct())
        new = _fingerprint(now)
        if new == state:
            break
        state = new
    roots = now.select(F.col("u").alias("node")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)), F.coalesce(F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 24))), F.lit(0))).first())
