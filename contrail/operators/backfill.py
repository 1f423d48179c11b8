"""Batch flatten of staged bronze rows into the mart, safe to re-run.

Snapshots whose ``load_id`` is already in the mart are skipped (anti-join on
the mart's distinct ids, which is one row per snapshot, not per aircraft),
so a manual re-run appends nothing twice.

The mart is partitioned by ``upload_date`` and ``writer``: each batch write and
each stream micro-batch writes folders of its own, and the mart's index names
those that are whole (``mart_index``). All readers go by the index.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail import schemas
from contrail.operators import mart_index as ix
from contrail.operators.flatten import flatten
from contrail.operators.mart_index import MART_STORED  # noqa: F401


def read_mart(spark: SparkSession, mart_root: str, until: datetime | None = None) -> DataFrame:
    """The stored mart; with ``until`` only the folders of upload dates up to its date."""
    found = ix.zones(spark, mart_root)
    if until is not None:
        found = [z for z in found if z.upload_date <= until.date().isoformat()]
    return ix.read(spark, mart_root, found).select(*schemas.MART_COLUMNS)


def read_latest_day(spark: SparkSession, mart_root: str, until: datetime | None = None) -> DataFrame:
    """Mart rows of the folders that can hold the latest snapshot (with ``until``, the one that was latest then)."""
    return ix.read(spark, mart_root, ix.with_latest(ix.zones(spark, mart_root), until)).select(*schemas.MART_COLUMNS)


def read_top_load(spark: SparkSession, mart_root: str) -> DataFrame:
    """Mart rows of the folders that hold the greatest ``load_id``."""
    return ix.read(spark, mart_root, ix.with_top_load(ix.zones(spark, mart_root))).select(*schemas.MART_COLUMNS)


def read_positions(spark: SparkSession, mart_root: str, start: datetime, end: datetime) -> DataFrame:
    """Mart rows of the folders that can hold reports with ``start <= time_position < end``."""
    return ix.read(spark, mart_root, ix.with_positions(ix.zones(spark, mart_root), start, end)).select(*schemas.MART_COLUMNS)


def write_mart(mart: DataFrame, mart_root: str) -> None:
    """Append mart rows partitioned by upload date, sorted for row-group stats.

    The ``rebalance`` hint lets AQE size the output per date folder: small
    days are coalesced into few files, a hot day is split over many tasks.
    """
    writer = ix.new_writer()
    (mart.withColumn("upload_date", F.to_date("uploaded_at"))
     .hint("rebalance", "upload_date")
     .sortWithinPartitions("uploaded_at")
     .withColumn("writer", F.lit(writer))
     .write.mode("append").partitionBy("upload_date", "writer").parquet(mart_root))
    ix.register(mart.sparkSession, mart_root, writer)


def write_mart_batch(mart: DataFrame, mart_root: str, writer: str) -> None:
    """Write one stream micro-batch as ``writer``; a second write of it replaces the first."""
    (mart.withColumn("upload_date", F.to_date("uploaded_at")).withColumn("writer", F.lit(writer))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("upload_date", "writer").parquet(mart_root))
    ix.register(mart.sparkSession, mart_root, writer)


def not_in_mart(todo: DataFrame, mart_root: str, origin: str | None = None) -> DataFrame:
    """Bronze rows whose ``load_id`` is not in the mart (with ``origin``: not written from there).

    Only folders whose zone meets the range of the new ids are opened; often there is none.
    """
    found = [z for z in ix.zones(todo.sparkSession, mart_root) if origin in (None, z.origin)]
    if not found:
        return todo
    ids = todo.agg(F.min("load_id").alias("lo"), F.max("load_id").alias("hi")).first()
    found = ix.with_loads(found, ids["lo"], ids["hi"]) if ids["lo"] is not None else []
    if not found:
        return todo
    done = ix.read(todo.sparkSession, mart_root, found).select("load_id").distinct()
    return todo.join(done, "load_id", "left_anti")


def backfill(spark: SparkSession, bronze: DataFrame, mart_root: str, **flatten_opts) -> None:
    """Flatten every bronze snapshot not yet in the mart and append it."""
    todo = not_in_mart(bronze.select("load_id", "ingest_time", "data"), mart_root)
    write_mart(flatten(todo, **flatten_opts), mart_root)
