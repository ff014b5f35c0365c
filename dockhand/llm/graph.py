"""Connected components by alternating large-star and small-star rounds.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.)
Every round is a partial aggregate and an equi-join on the edge list; the
edges stay distributed, are written to the shared folder after each round,
and nothing but two totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import settle


def _totals(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id on an edge; component is the smallest id
    reachable.  Ids without an edge do not appear.  Self-edges and repeated
    edges are harmless; null ends are ignored."""
    now = settle(edges.where(F.col(a) != F.col(b))
                 .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _totals(now)
    while seen[0]:
        nxt = settle(_small_star(_large_star(now).where("u != v").distinct()).where("u != v").distinct())
        totals = _totals(nxt)
        now = nxt
        if totals == seen:
            break
        seen = totals
    # at the fixed point every edge joins a node to its component's least node
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
