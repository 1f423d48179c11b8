"""Streaming versions of the pipeline stages.

* ``bronze_stream``: new landing files (one API response each) -> bronze
  rows. Ids continue the bronze maximum in (mtime, path) order and are tied to
  the micro-batch id, so a replayed batch rewrites the same ids into the same
  ``batch_id=`` folder instead of appending twice.
* ``flatten_stream``: bronze -> mart, one ``writer=`` partition per micro-batch;
  stateless and narrow. Started on an empty checkpoint it also back-fills
  everything already staged (``availableNow``). Snapshots a batch job has put
  into the same mart are left out, and a finished micro-batch that is replayed
  is left alone.
* ``hourly_stream``: airborne reports -> one row per (country, hour) emitted
  once, after the watermark passes the hour. ``count(distinct)`` is not
  allowed on a stream, so two chained stateful aggregations do it exactly:
  per (hour, country, aircraft) partial sums, then per (hour, country)
  totals - state is spread by aircraft, never one set per hot country. Marks of
  a clock, a source of their own, move the watermark where reports pause, so
  the last hours close with a delay of minutes; no mark enters the mart or a state.
* ``late_hours_stream``: reports for hours that are closed already (the
  watermark drops them above) are noted in a side table, and exactly their
  hours are worked out again from the mart and overwritten.
* ``latest_refresh_stream``: after each mart micro-batch, re-export the
  latest snapshot if the batch brought a newer one.

Triggers: ``"available_now"`` (process what is there, then stop) or a
processing-time interval such as ``"300 seconds"`` (the polling cadence).
"""

from __future__ import annotations

from datetime import datetime, timedelta
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail import schemas
from contrail.functions.casts import exact_part, mean_of, other_part, round_ch
from contrail.functions.time import instant_to_ntz, ntz_literal, ntz_to_instant
from contrail.operators import mart_index as ix
from contrail.operators.backfill import not_in_mart, read_latest_day, read_positions, write_mart_batch
from contrail.operators.flatten import flatten
from contrail.operators.hourly import hourly
from contrail.session import ensure_checkpoint_dir
from contrail.sources import fs, manifest, sinks
from contrail.sources.bronze import BRONZE_STORED, bronze_rows, number_files, read_payloads


def run_trigger(writer, trigger: str):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


# --- landing -> bronze --------------------------------------------------------

FILES = "path string, modificationTime timestamp, length long, content binary"


def _bronze_batch(spark: SparkSession, bronze_root: str, order_by: str):
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if fs.is_committed(spark, f"{bronze_root}/batch_id={batch_id}"):
            return  # a replay: new file names would reach the mart a second time
        # Ids grow with batch ids: the previous maximum is in the newest earlier
        # batch folder, found by listing (metadata) - no scan of older batches.
        prev = 0
        earlier = sorted((int(n.split("=", 1)[1]) for n in fs.list_dirs(spark, bronze_root)
                          if n.startswith("batch_id=") and int(n.split("=", 1)[1]) < batch_id), reverse=True)
        for b in earlier:
            path = f"{bronze_root}/batch_id={b}"
            if fs.is_committed(spark, path):
                prev = spark.read.parquet(path).agg(F.max("load_id")).first()[0] or prev
                if prev:
                    break
        # The batch holds names, times and sizes only; the tasks that hold the ids read the payloads.
        out = bronze_rows(read_payloads(number_files(batch, order_by, prev)))
        out.write.mode("overwrite").parquet(f"{bronze_root}/batch_id={batch_id}")
    return on_batch


def bronze_stream(spark: SparkSession, landing_root: str, bronze_root: str, checkpoint: str,
                  trigger: str = "300 seconds", max_files_per_trigger: int | None = None,
                  order_by: str = "mtime") -> StreamingQuery:
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(landing_root).select(  # without ``content``, so no file is read here
        F.col("path").alias("source_file"), F.unix_millis("modificationTime").alias("mtime_ms"), F.col("length").alias("file_size"))
    w = files.writeStream.foreachBatch(_bronze_batch(spark, bronze_root, order_by)).option("checkpointLocation", checkpoint)
    return run_trigger(w, trigger).start()


def read_stream_bronze(spark: SparkSession, bronze_root: str) -> DataFrame:
    return spark.read.parquet(bronze_root).select(
        *[F.col(f.name).cast(f.dataType) for f in BRONZE_STORED.fields])


# --- bronze -> mart -----------------------------------------------------------

def flatten_stream(spark: SparkSession, bronze_root: str, mart_root: str, checkpoint: str,
                   trigger: str = "300 seconds", max_files_per_trigger: int | None = None,
                   compact_every: int | None = None, **flatten_opts) -> StreamingQuery:
    """``compact_every`` merges the mart's small folders after every so many micro-batches."""
    reader = spark.readStream.schema(BRONZE_STORED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    bronze = reader.parquet(bronze_root)
    # The checkpoint names the stream: its restarts keep the names of its batches.
    stream = md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        done = f"{mart_root}/_batches/{stream}-{batch_id}"
        if fs.exists(spark, done):
            return
        todo = not_in_mart(batch.select("load_id", "ingest_time", "data"), mart_root, ix.BATCH)
        write_mart_batch(flatten(todo, **flatten_opts), mart_root, f"{stream}-{batch_id}")
        fs.touch(spark, done)
        if compact_every and (batch_id + 1) % compact_every == 0:
            ix.compact(spark, mart_root)

    w = bronze.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return run_trigger(w, trigger).start()


# --- mart -> hourly gold ------------------------------------------------------

def _mart_stream(spark: SparkSession, mart_root: str, max_files_per_trigger: int | None) -> DataFrame:
    """Rows as they enter the mart; folders that compaction makes hold none that did not stream before."""
    reader = spark.readStream.schema(ix.MART_STORED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(mart_root).where(~F.col("writer").contains(ix.MERGED))


def advance_clock(spark: SparkSession, clock_root: str, when: datetime) -> None:
    """Leave a mark: no report of before ``when`` (UTC) less the stream's delay is still to come.

    One small file; the stream deletes marks it has read. The newest mark stays known for late reports.
    """
    mark = spark.range(1).select(ntz_to_instant(ntz_literal(when)).alias("event_time"))
    mark.write.mode("append").parquet(clock_root)
    manifest.publish(spark, f"{clock_root}/_newest", manifest.newest(spark, f"{clock_root}/_newest"), {"mark": when.isoformat(sep=" ")})


def closed_until(spark: SparkSession, gold_root: str, clock_root: str | None, delay: timedelta) -> datetime | None:
    """Up to when hours are closed: the end of the newest exported one, or the clock's newest mark less the delay."""
    ends = []
    if fs.exists(spark, gold_root):
        begin = F.col("fly_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("fly_hour"))
        newest = sinks.read_hourly(spark, gold_root).agg(F.max(begin)).first()[0]  # folder names only
        if newest is not None:
            ends.append(newest + timedelta(hours=1))
    mark = manifest.newest(spark, f"{clock_root}/_newest").state.get("mark") if clock_root else None
    if mark:
        ends.append(datetime.fromisoformat(mark) - delay)
    return max(ends, default=None)


def _with_clock(spark: SparkSession, reports: DataFrame, clock_root: str, delay: str) -> DataFrame:
    """``reports`` under one watermark with the clock's marks, which are dropped behind it."""
    marks = (spark.readStream.schema("event_time timestamp").option("cleanSource", "delete").parquet(clock_root)
             .select("event_time", F.lit(True).alias("mark")))
    both = reports.withColumn("mark", F.lit(False)).unionByName(marks, allowMissingColumns=True).withWatermark("event_time", delay)
    # The filter names the event time, or the optimizer would move it below the watermark and hide the marks from it.
    return both.where(~F.col("mark") | F.col("event_time").isNull()).drop("mark")


def hourly_stream(spark: SparkSession, mart_root: str, gold_root: str, checkpoint: str,
                  delay: str = "10 minutes", trigger: str = "300 seconds",
                  max_files_per_trigger: int | None = None, clock_root: str | None = None) -> StreamingQuery:
    """With ``clock_root`` (a folder that ``advance_clock`` has written to), its marks close hours too."""
    mart = _mart_stream(spark, mart_root, max_files_per_trigger)
    airborne = (mart.where((F.col("on_ground") == F.lit(False)) & F.col("time_position").isNotNull())
                .select(ntz_to_instant("time_position").alias("event_time"),  # watermarks need TIMESTAMP
                        "origin_country", "icao24", "velocity", "baro_altitude"))
    airborne = _with_clock(spark, airborne, clock_root, delay) if clock_root else airborne.withWatermark("event_time", delay)
    # Stage 1, per (hour, country, aircraft): exact partial sums. State is
    # keyed by aircraft, so a country with most of the traffic is spread
    # over all tasks instead of one growing set.
    per_aircraft = (airborne
                    .groupBy(F.window("event_time", "1 hour"), "origin_country", "icao24")
                    .agg(F.sum(exact_part("velocity")).alias("sv"), F.sum(other_part("velocity")).alias("ov"),
                         F.count("velocity").alias("nv"),
                         F.sum(exact_part("baro_altitude")).alias("sa"), F.sum(other_part("baro_altitude")).alias("oa"),
                         F.count("baro_altitude").alias("na")))
    # Stage 2, per (hour, country): a few numbers of state per key. Distinct
    # aircraft = non-null aircraft keys; means = exact sums / counts.
    agg = (per_aircraft
           .groupBy(F.window(F.window_time("window"), "1 hour").alias("window"), "origin_country")
           .agg(F.count("icao24").alias("fly_count"),
                round_ch(mean_of(F.sum("sv"), F.sum("ov"), F.sum("nv")), 2).alias("hourly_avg_velocity"),
                round_ch(mean_of(F.sum("sa"), F.sum("oa"), F.sum("na")), 2).alias("hourly_avg_altitude")))
    start = instant_to_ntz(F.col("window.start"))
    out = agg.select("origin_country", F.to_date(start).alias("fly_date"), F.hour(start).alias("fly_hour"),
                     "fly_count", "hourly_avg_velocity", "hourly_avg_altitude")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Dynamic overwrite of just the emitted hours: a replayed batch is harmless.
        sinks.export_hourly(batch, gold_root)

    w = (out.writeStream.outputMode("append").foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint))
    return run_trigger(w, trigger).start()


# --- late reports -------------------------------------------------------------

def recompute_hours(spark: SparkSession, mart_root: str, gold_root: str, hours: DataFrame) -> None:
    """Work out the given (fly_date, fly_hour) again from the mart and overwrite exactly them."""
    begin = (F.col("fly_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("fly_hour")))
    ends = hours.agg(F.min(begin).alias("lo"), F.max(begin).alias("hi")).first()
    start, end = ends["lo"], ends["hi"] + timedelta(hours=1)
    mart = read_positions(spark, mart_root, start, end)
    hour = [F.to_date("time_position").alias("fly_date"), F.hour("time_position").alias("fly_hour")]
    wanted = mart.select("*", *hour).join(hours.select("fly_date", "fly_hour"), ["fly_date", "fly_hour"], "left_semi")
    sinks.export_hourly(hourly(wanted.select(*schemas.MART_COLUMNS), start, end), gold_root)


def late_hours_stream(spark: SparkSession, mart_root: str, gold_root: str, late_root: str, checkpoint: str,
                      trigger: str = "300 seconds", max_files_per_trigger: int | None = None,
                      clock_root: str | None = None, delay: timedelta = timedelta(minutes=10)) -> StreamingQuery:
    """Side table ``late_root`` (fly_date, fly_hour, reports; one folder a micro-batch) and the hours in it redone.

    A report is late when its hour has been closed as it arrives, be the hour
    exported or without any report so far. Redoing an hour needlessly gives the
    same rows, so a replayed micro-batch is harmless.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        until = closed_until(spark, gold_root, clock_root, delay)
        if until is None:
            return
        airborne = batch.where((F.col("on_ground") == F.lit(False)) & (F.col("time_position") < ntz_literal(_hour_of(until))))
        late = (airborne.groupBy(F.to_date("time_position").alias("fly_date"), F.hour("time_position").alias("fly_hour"))
                .agg(F.count(F.lit(1)).alias("reports")))
        path = f"{late_root}/batch_id={batch_id}"
        late.write.mode("overwrite").parquet(path)
        late = spark.read.schema("fly_date date, fly_hour int, reports long").parquet(path)
        if not late.isEmpty():
            recompute_hours(spark, mart_root, gold_root, late)

    w = _mart_stream(spark, mart_root, max_files_per_trigger).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return run_trigger(w, trigger).start()


def _hour_of(t: datetime) -> datetime:
    return t.replace(minute=0, second=0, microsecond=0)


# --- mart -> latest gold ------------------------------------------------------

def latest_refresh_stream(spark: SparkSession, mart_root: str, gold_root: str, checkpoint: str,
                          trigger: str = "300 seconds",
                          max_files_per_trigger: int | None = None, keep_versions: int = 24) -> StreamingQuery:
    mart = _mart_stream(spark, mart_root, max_files_per_trigger)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        top = batch.agg(F.max("uploaded_at").alias("t"), F.max("load_id").alias("v")).first()
        if top is None or top["t"] is None:
            return
        current = sinks.read_latest(spark, gold_root).agg(F.max("uploaded_at")).first()[0]
        if current is not None and current > top["t"]:
            return  # the batch brought only older snapshots
        # Equal: more parts of the served snapshot arrived; export it again.
        # Re-read the whole snapshot from the table: its parts may span batches.
        full = (read_latest_day(spark, mart_root, until=top["t"])
                .where(F.col("uploaded_at") == F.lit(top["t"].isoformat(sep=" ")).cast("timestamp_ntz")))
        version = full.agg(F.max("load_id")).first()[0]
        sinks.export_latest(full, gold_root, version, revision=batch_id)
        sinks.prune_versions(spark, gold_root, keep_versions)

    w = mart.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return run_trigger(w, trigger).start()
