"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import checkpoint


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Map every node of edges (a long, b long) to the smallest node reachable: (node, root).

    Each round is two keyed aggregations with map-side minima and two equi-joins against a
    unique side, so a hub with many neighbours only meets one row, which adaptive execution
    can split. Rounds are cut by reliable checkpoints; the driver sees one row per round.
    Self-links are allowed; nulls take no part; no edges give no rows.
    """
    edges = checkpoint(edges.where("a is not null and b is not null"))  # costly to find; used twice
    loops = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    e = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = checkpoint(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root"))
    found = e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots).distinct()
    return found.unionByName(loops.join(found, "node", "left_anti").select("node", F.col("node").alias("root")))
