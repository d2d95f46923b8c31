"""Connected components of a link table, by alternating large-star and
small-star rounds (every round links each node to the smallest neighbour it
knows; a forest of stars remains).  Each round is written to the shared
checkpoint folder, so lineage stays short and a lost executor costs at most
a round.  Only two numbers per round reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import store


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def star_forest(links: DataFrame) -> DataFrame:
    """(u, v) long links in either direction -> (u, v): each node that is
    not the smallest of its component, and that smallest node."""
    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = store(pairs, "links")
    before = _state(pairs)
    while before[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        pairs = store(small.where("u <> v").distinct(), "links")
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs
