"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key (md5 of its id). Within a source the
keys are cut into equal key ranges, so a hot source spreads over all of them;
sums per (source, range) give each range its offset and a window inside the
range gives each document the exact prefix sum of sizes. A source's budget is
its whole epochs plus a cut at the exact word.

Defined results: null text has size 0; null source is a source of its own and
comes last; rows that repeat an id count as rows of their own; an empty table
gives an empty result; a source of size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.llm.words import word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
RANGE_HEX = 2  # leading hex digits of the key that name its range: 256 ranges per source


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            share: float = 1.0) -> DataFrame:
    """Per source: its size and target, from a (source, size) table.

    Water filling in closed form. Sources are ordered by cap / weight; the
    first whose cap exceeds its part of what the earlier ones leave, and all
    after it, share that remainder by weight. The windows run over one row per
    source.
    """
    by_source = Window.orderBy(F.col("source").isNull(), "source")
    per = (sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
           .withColumn("pick", (F.row_number().over(by_source) - 1) % len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("pick") + 1)
    per = per.withColumn("weight", weight).withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    order = (F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("total", F.sum("source_size").over(whole) * F.lit(share))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("weight_left"))
           .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight")))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(whole)["level"]
    return (per.withColumn("final", level)
            .select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("final")).alias("target")))


def plan(docs: DataFrame, text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
         max_epochs: int = MAX_EPOCHS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: size, its source's size and target, key, prefix sum, ``taken`` words."""
    sized = docs.select(F.col("doc_id"), F.col("source"), word_count(F.col(text_col)).alias("size"),
                        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"), *carry)
    # A key that is never null, so that the join below finds rows dealt as the window dealt them.
    part = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    sized = sized.withColumn("part", part).withColumn("rng", F.substring("key", 1, RANGE_HEX))
    per_range = (sized.groupBy("part", "rng")
                 .agg(F.sum("size").cast("long").alias("size"), F.first("source").alias("source")))
    goal = targets(per_range, weights, max_epochs)
    goal = goal.select(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
                       .alias("part"), "source_size", "target")
    ahead = Window.partitionBy("part").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select("part", "rng", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    side = offsets.join(goal, "part")
    inside = (Window.partitionBy("part", "rng").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranged = sized.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ranged.join(side, ["part", "rng"])
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0))
    joined = joined.withColumn("prefix", F.col("offset") + F.col("ahead")).withColumn("epochs", epochs.cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("prefix")
    cut = F.least(F.col("size"), F.greatest(rest, F.lit(0)))
    return joined.withColumn("taken", (F.col("epochs") * F.col("size") + cut).cast("long")).drop("part", "rng", "ahead", "offset")


def report(docs: DataFrame) -> DataFrame:
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def copies() -> Column:
    """Whole copies of a planned document: its epochs, and one more if the cut takes at least half of it."""
    cut = F.col("taken") - F.col("epochs") * F.col("size")
    return (F.col("epochs") + F.when((F.col("size") > 0) & (2 * cut >= F.col("size")), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, whole texts only.

    The rows travel once, to their (source, key range); the offsets join them
    there without another shuffle.
    """
    cols = docs.columns
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), "doc_id", "source", "text")
    planned = plan(body, weights=weights, max_epochs=max_epochs, carry=("row",))
    return (planned.withColumn("again", F.explode(F.array_repeat(F.lit(1), copies())))
            .select(*[F.col("row")[c].alias(c) for c in cols]))
