"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.frames import staged


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return tuple(r)


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (columns u, v; bigint), for every
    id with a link.  Links with a null and links of an id with itself are left out.

    Large-star and small-star steps alternate until the links no longer change,
    which are then stars around each smallest id.  Every step is a grouping and a
    join on the node; its result is written to the shared folder, so neither the
    plan nor what a lost executor costs grows with the rounds.
    """
    spark = links.sparkSession
    edges = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u > v").distinct(), "links")
    before = _print(edges)
    for _ in range(rounds):
        if before[0] == 0:
            break
        # large star: every neighbour above u is linked to the smallest of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # small star: u and its neighbours below it are linked to the smallest of them
        large = staged(large.where("u > v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, "small-star")
        after = _print(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
