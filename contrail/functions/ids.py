"""Dense consecutive ids in a global order, without a single-partition sort.

``monotonically_increasing_id`` is ``(partition << 33) + position`` - unique
but not dense. After a range partitioning and a sort within partitions, the
position is the row's rank inside its partition; adding the number of rows
in all earlier partitions (a table of at most ``partitions`` rows, so its
broadcast is bounded by construction) gives the dense global rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from contrail.session import ensure_checkpoint_dir


def dense_ids(df: DataFrame, order_by: list[str], start: int, name: str = "load_id",
              partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = start + 1, start + 2, ... in ``order_by`` order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    k = partitions or max(1, spark.sparkContext.defaultParallelism)
    tagged = (df.repartitionByRange(k, *order_by).sortWithinPartitions(*order_by)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint())  # fixes the partition assignment for both uses below
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_pid", F.coalesce(before, F.lit(0)).alias("_offset"))  # <= k rows
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.lit(start) + F.col("_offset") + local + 1)
            .drop("_pid", "_mid", "_offset"))
