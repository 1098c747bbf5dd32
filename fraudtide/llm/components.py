"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudtide.llm.tables import materialised


def _downward(df: DataFrame) -> DataFrame:
    ends = df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id that a link ``a, b`` names: the smallest id it is joined to.

    Large and small stars in turn: every id passes its smallest neighbour to the larger ones, then to
    the smaller ones, until nothing changes. Neighbours are never gathered, only their smallest one
    is; every round is written out, so a lost executor costs one round at most.
    """
    links = materialised(_downward(links), "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return (
                links.select(F.col("a").alias("id"), F.col("b").alias("component"))
                .unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
            )
        before = tuple(state)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialised(_downward(large), "links")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialised(_downward(small.unionByName(smallest.select("a", F.col("m").alias("b")))), "links")
