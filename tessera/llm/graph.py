"""Connected components of an undirected link table, by alternating large-star
and small-star rounds (each row moves to the smallest neighbour known)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

EDGES_PER_TASK = 100_000       # a round's tables are written by as many tasks as their rows need
MAX_ROUNDS = 60                # rounds grow with the logarithm of the rows; beyond this something is wrong


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): smallest id reachable, for every id that is linked.

    Links are long pairs, in any order, repeated or not. Every round is written
    as a table, so a lost executor costs one round, and both sides of a round's
    join are plain tables, so a hub's rows can be split."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, seen = materialize(edges, "links"), None
    for _ in range(MAX_ROUNDS):
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark

        def write(df: DataFrame, name: str, tasks: int = -(-mark[0] // EDGES_PER_TASK)) -> DataFrame:
            return materialize(df.coalesce(tasks), name)

        # Large star: larger neighbours of u go to u's smallest neighbour, or to u.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = write(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large-star")
        large = write(both.where("v > u").join(mins, "u")
                      .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        # Small star: smaller neighbours of u, and u, go to the smallest of them.
        mins = write(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        moved = large.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write(moved.unionByName(mins.select("u", F.col("m").alias("v"))).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ids.unionByName(roots)
