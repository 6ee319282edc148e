"""Connected components of links, by alternating large-star and small-star steps.

Each step points nodes at the smallest neighbour they see; minima are partially aggregated before
the shuffle and joined back, so a hub with a third of all nodes is split by the join.  Every round
is written to the shared folder; two numbers per round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import written


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
        "u <> v").union(low.select("u", F.col("m").alias("v")))


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (x, y) that is not a root itself."""
    e = written(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where(
        "u <> v").distinct(), "edges")
    seen = None
    for _ in range(most):
        e = written(_small(_large(e)).distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {most} rounds")
