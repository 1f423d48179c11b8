"""Gold sinks: the latest snapshot (versioned) and hourly analytics (per hour).

Latest: each export writes a new ``version=<n>`` folder; readers take the
highest committed version. A reader therefore never sees a half-written
snapshot, and a retried export rewrites only its own version.

Hourly: partitioned by ``fly_date``/``fly_hour`` with dynamic partition
overwrite, so re-running one hour replaces that hour and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail import schemas
from contrail.session import ensure_checkpoint_dir
from contrail.sources import fs

_VERSION = "version="


def export_latest(latest: DataFrame, root: str, version: int, revision: int | None = None) -> str:
    """Write one snapshot as snappy Parquet under ``root/version=<n>[-<rev>]``.

    ``revision`` gives a re-export of the same snapshot (e.g. after more of
    its parts arrived) its own, later-sorting folder, so a folder is never
    rewritten while readers may use it.
    """
    name = f"{version:020d}" if revision is None else f"{version:020d}-{revision:010d}"
    path = f"{root.rstrip('/')}/{_VERSION}{name}"
    (latest.write.mode("overwrite").option("compression", "snappy").parquet(path))
    return path


def latest_version_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest committed version, or None."""
    names = sorted(n for n in fs.list_dirs(spark, root) if n.startswith(_VERSION))
    for name in reversed(names):
        path = f"{root.rstrip('/')}/{name}"
        if fs.is_committed(spark, path):
            return path
    return None


def prune_versions(spark: SparkSession, root: str, keep: int) -> int:
    """Delete all but the newest ``keep`` committed versions; returns how many.

    Keeps the folder listing (what every reader does) bounded. Only versions
    older than the ``keep`` newest committed ones are removed, so readers of
    the current snapshot are never affected; uncommitted folders newer than
    the kept ones (an export in progress) are left alone.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    names = sorted(n for n in fs.list_dirs(spark, root) if n.startswith(_VERSION))
    committed = [n for n in names if fs.is_committed(spark, f"{root.rstrip('/')}/{n}")]
    if len(committed) <= keep:
        return 0
    cutoff = committed[-keep]
    old = [n for n in names if n < cutoff]
    for n in old:
        fs.delete(spark, f"{root.rstrip('/')}/{n}")
    return len(old)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The served latest snapshot with the mart schema (never inferred)."""
    path = latest_version_path(spark, root)
    if path is None:
        return spark.createDataFrame([], schemas.MART)
    return spark.read.schema(schemas.MART).parquet(path)


def export_hourly(hourly: DataFrame, root: str) -> None:
    """Write hourly rows into their (fly_date, fly_hour) partitions.

    Only the partitions present in ``hourly`` are replaced. The aggregated
    rows (a few hundred per hour) are checkpointed first: lineage is cut, so
    a failed write task never recomputes the aggregation over the mart, and
    the number of hours is known. Rows are then hash-partitioned by hour over
    ``min(hours, cores)`` tasks: one file per hour, written in parallel.
    """
    ensure_checkpoint_dir(hourly.sparkSession)
    hourly = hourly.checkpoint()
    n_hours = hourly.select("fly_date", "fly_hour").distinct().count()
    if n_hours == 0:
        return
    n = max(1, min(n_hours, hourly.sparkSession.sparkContext.defaultParallelism))
    (hourly.repartition(n, "fly_date", "fly_hour")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy")
     .partitionBy("fly_date", "fly_hour")
     .parquet(root))


def read_hourly(spark: SparkSession, root: str) -> DataFrame:
    """All exported hours as one table; partition filters prune folders."""
    df = spark.read.schema(schemas.HOURLY).parquet(root)
    return df.select(*[F.col(f.name) for f in schemas.HOURLY.fields])
