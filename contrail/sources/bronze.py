"""Landing files -> bronze snapshot table.

One landing file holds one raw API response. Loading a folder appends the
files not yet in bronze, one row each, with

* ``load_id``: consecutive numbers continuing the bronze maximum, in order of
  (file modification time, path) - or path only, for replayable numbering;
* ``ingest_time``: the payload's own ``time`` (seconds), else the file time.

Only the small listing (path, mtime, size) is sorted and numbered, and the plan
of ids is the plan of reads: each task opens the files whose ids it holds. A
payload is read once, where it is written; it is never shuffled. Files are listed
as they are, hidden and empty ones too (``listing``).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from contrail.functions.casts import u32_or_null
from contrail.functions.ids import dense_ids
from contrail.functions.time import instant_to_ntz, seconds_to_ntz
from contrail.operators.flatten import state_count
from contrail.sources import fs
from contrail.sources.fs import _by_value, arrow_fs
from contrail.sources.listing import list_tree

log = logging.getLogger("contrail.bronze")

BRONZE_STORED = T.StructType([
    T.StructField("load_id", T.LongType(), False),
    T.StructField("ingest_time", T.TimestampNTZType(), False),
    T.StructField("data", T.StringType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("ingest_date", T.DateType(), True),
])

# Payload bytes a task reads in all, and holds at a time.
TASK_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def land_snapshots(parts: DataFrame, landing_root: str) -> None:
    """Drop each bronze-shaped row ``(load_id, part, data)`` as one landing file.

    This plays the producer (the API poller): every snapshot part becomes
    ``<load_id>-<part>.json`` (zero padded, so path order is load order),
    written by the executors straight to its final name. Names are
    deterministic, so a retried task rewrites the same files.
    """
    from contrail.sources.fixtures import write_named_files
    root = fs.resolved(parts.sparkSession, landing_root).rstrip("/") + "/"
    named = parts.select(
        F.concat(F.lit(root), F.lpad(F.col("load_id").cast("string"), 12, "0"), F.lit("-"),
                 F.lpad(F.col("part").cast("string"), 8, "0"), F.lit(".json")).alias("path"),
        F.col("data").alias("content"))
    write_named_files(named)


def read_bronze(spark: SparkSession, bronze_root: str) -> DataFrame:
    return spark.read.schema(BRONZE_STORED).parquet(bronze_root)


def number_files(files: DataFrame, order_by: str, after: int) -> DataFrame:
    """(load_id, source_file, mtime_ms, file_size) of the files: ids go on from ``after``. Computed once and stored."""
    keys = ["mtime_ms", "source_file"] if order_by == "mtime" else ["source_file"]
    return dense_ids(files.select("source_file", "mtime_ms", "file_size"), keys, after).checkpoint()


def read_payloads(numbered: DataFrame) -> DataFrame:
    """``numbered`` with ``data``, the text of each file, read by the tasks that hold the ids.

    The ids are cut into consecutive ranges of about ``TASK_BYTES`` of payload,
    so a task's rows belong to few days.
    """
    spark = numbered.sparkSession
    size = numbered.agg(F.sum("file_size")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    to_fs, batch_bytes = _by_value(arrow_fs), BATCH_BYTES

    def run(batches):  # runs in Python workers: references nothing of this package
        import pyarrow as pa

        def rows(batch, keep, texts):
            data = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            return pa.RecordBatch.from_arrays([*batch.slice(keep, len(texts)).columns, data], [*batch.schema.names, "data"])

        for batch in batches:
            begin, held = 0, []
            for i, key in enumerate(batch.column("source_file").to_pylist()):
                filesystem, path = to_fs(key)
                with filesystem.open_input_stream(path) as stream:
                    held.append(stream.read())
                if sum(map(len, held)) >= batch_bytes:
                    yield rows(batch, begin, held)
                    begin, held = i + 1, []
            if held:
                yield rows(batch, begin, held)

    columns = "load_id long, source_file string, mtime_ms long, file_size long"
    plan = numbered.select("load_id", "source_file", "mtime_ms", "file_size").repartitionByRange(tasks, "load_id")
    return plan.mapInArrow(run, f"{columns}, data string")


def bronze_rows(payloads: DataFrame, time_source: str = "payload") -> DataFrame:
    """Stored bronze rows of read payloads."""
    file_time = instant_to_ntz(F.timestamp_millis("mtime_ms"))
    t = F.coalesce(payload_time(F.col("data")), file_time) if time_source == "payload" else file_time
    return payloads.select("load_id", t.alias("ingest_time"), "data", "source_file", F.to_date(t).alias("ingest_date"))


def load_landing(spark: SparkSession, landing_root: str, bronze_root: str,
                 order_by: str = "mtime", time_source: str = "payload",
                 count_states: bool = True) -> int:
    """Append new landing files to bronze; returns the number of files loaded.

    The load logs how many snapshots it wrote (an ``observe`` metric of the
    write itself), and with ``count_states`` how many state vectors they
    hold, at the price of parsing every payload once more.
    """
    if order_by not in ("mtime", "path") or time_source not in ("payload", "file"):
        raise ValueError("order_by in (mtime, path), time_source in (payload, file)")
    new_files = list_tree(spark, landing_root).withColumnRenamed("file_key", "source_file")
    prev_max = 0
    if fs.exists(spark, bronze_root):
        bronze = read_bronze(spark, bronze_root)
        new_files = new_files.join(bronze.select("source_file"), "source_file", "left_anti")
        prev_max = bronze.agg(F.max("load_id")).first()[0] or 0
    numbered = number_files(new_files, order_by, prev_max)
    n_new = numbered.count()
    if n_new == 0:
        return 0
    out = bronze_rows(read_payloads(numbered), time_source)
    # Counts of this load, gathered during the write itself.
    obs = Observation("landing_load")
    metrics = [F.count(F.lit(1)).alias("snapshots")]
    if count_states:
        metrics.append(F.sum(state_count(F.col("data"))).alias("states"))
    out.observe(obs, *metrics).write.mode("append").partitionBy("ingest_date").parquet(bronze_root)
    stats = obs.get
    if count_states:
        log.info("bronze load: %s snapshots holding %s states", stats.get("snapshots"), stats.get("states"))
    else:
        log.info("bronze load: %s snapshots", stats.get("snapshots"))
    return n_new


def payload_time(data: Column) -> Column:
    """The snapshot's own time; NULL when missing or no unsigned 32-bit second count."""
    return seconds_to_ntz(u32_or_null(F.get_json_object(data, "$.time")))


def snapshot_sizes(bronze: DataFrame) -> DataFrame:
    """Per bronze row: its state count (0 for null/empty/missing/bad states)."""
    return bronze.select("load_id", F.col("ingest_time").alias("uploaded_at"),
                         state_count(F.col("data")).cast("bigint").alias("n_states"))
