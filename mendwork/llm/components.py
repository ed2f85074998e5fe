"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

MAX_ROUNDS = 64


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b); the component is its smallest id.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its smallest
    neighbour, then every node and its smaller neighbours are. A component ends as a star around its
    smallest id; the number of rounds grows with the logarithm of the longest path. Each round is written
    to the shared folder. Minima are pre-aggregated, so a node with very many links is no hot spot there;
    the join that follows is split by Spark where a node is hot. Null ids and links to oneself are dropped.
    """
    links = links.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    state, last = materialise(links.distinct(), "links"), None
    for _ in range(MAX_ROUNDS):
        state = materialise(_small_star(_large_star(state)), "links")
        # Order-free signature of the links; a star forest maps to itself.
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("links did not settle")
    stars = state.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # Rows (a, b) with b > a: b is linked to the smallest neighbour of a.
    joined = links.select(F.col("a").alias("b"), F.col("b").alias("a")).join(lowest, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    lowest = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(lowest, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(lowest.select("a", F.col("m").alias("b"))).distinct()
