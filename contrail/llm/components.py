"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contrail.llm.store import stored


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(doc, root): every linked id with the smallest id of its component, from (a, b) rows.

    Alternating star steps: each id hands its larger neighbours, then all of
    its smaller ones, to the smallest id it sees. Both steps are a minimum
    per id (combined before the shuffle) joined back, so a hub of any degree
    spreads over tasks. Stops when a round leaves the links as they were; only
    a row count and a checksum come to the driver.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).union(edges.select(F.col("u"), F.col("v")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = (both.where("y > x").join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
                 .where("u <> v").distinct())
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        edges = stored(small.select(F.col("u").alias("v"), F.col("m").alias("u"))
                       .union(least.select("v", F.col("m").alias("u"))).where("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(now) == seen:
            return edges.groupBy("v").agg(F.min("u").alias("u")).select(F.col("v").alias("doc"), F.col("u").alias("root"))
        seen = tuple(now)
    raise RuntimeError("components did not settle")
