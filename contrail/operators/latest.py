"""Latest snapshot and as-of snapshot views over the mart.

Both the high-water-mark form (rows whose ``uploaded_at`` equals the max) and
the rank form (``rank() over (order by load_id desc) = 1``) are written as a
scalar subquery plus a filter. That plans as an aggregate (partial per task,
one tiny final) and a filter that Parquet can push down; a literal global
``rank()`` would sort the whole mart in a single partition.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from contrail.functions.time import ntz_literal


def latest_by_watermark(mart: DataFrame, keep_marker: bool = False) -> DataFrame:
    """Rows of the most recent upload (max ``uploaded_at``)."""
    top = mart.agg(F.max("uploaded_at").alias("max_date")).scalar()
    out = mart.where(F.col("uploaded_at") == top)
    return out.withColumn("max_date", F.col("uploaded_at")) if keep_marker else out


def latest_by_rank(mart: DataFrame, keep_marker: bool = False) -> DataFrame:
    """Rows ranked first by ``load_id`` descending, ties kept."""
    top = mart.agg(F.max("load_id")).scalar()
    out = mart.where(F.col("load_id") == top)
    return out.withColumn("indx", F.lit(1)) if keep_marker else out


def snapshot_as_of(mart: DataFrame, as_of: datetime | str) -> DataFrame:
    """Time travel: the snapshot that was latest at ``as_of`` (inclusive)."""
    bound = ntz_literal(as_of)
    top = mart.where(F.col("uploaded_at") <= bound).agg(F.max("uploaded_at")).scalar()
    return mart.where(F.col("uploaded_at") == top)
