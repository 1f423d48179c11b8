"""Spark side of the query catalogue (see ``oracle.py`` for the SQL twins).

Every query reads the driver tables and builds the flight data through the
real path: events -> snapshot JSON (bronze) -> flatten (silver) -> gold.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, time, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail import schemas
from contrail import streaming as st
from contrail.functions import casts
from contrail.functions.memo import memo
from contrail.operators import backfill as bf
from contrail.operators import flatten as fl
from contrail.operators import hourly as hr
from contrail.operators import latest as lt
from contrail.operators import mart_index as ix
from contrail.operators import runlog as rl
from contrail.operators import serving as sv
from contrail.operators import views as vw
from contrail.plans import ingestion, params as P
from contrail.session import work_dir
from contrail.sources import bronze as br
from contrail.sources import fixtures
from contrail.sources import sinks
from contrail.sources.tables import read_table, sql_frame
from contrail.streaming.jobs import read_stream_bronze


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.snapshot_bronze(spark, sf_dir, P.STATES_PER_PART)


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.flatten(_bronze(spark, sf_dir))


def _mart_table(spark: SparkSession, sf_dir: str) -> str:
    """Write the silver mart once (partitioned by upload date) and return its
    folder; gold reads then prune to the folders they need, as in production."""
    root = work_dir(spark, "mart")
    bf.backfill(spark, _bronze(spark, sf_dir), f"{root}/mart")
    return f"{root}/mart"


def flatten_states(spark, sf_dir):
    return _mart(spark, sf_dir)


def flatten_strict(spark, sf_dir):
    return fl.flatten(_bronze(spark, sf_dir), mode="strict")


def flatten_cdc(spark, sf_dir):
    cdc = fl.flatten(_bronze(spark, sf_dir), id_name="id", cdc_markers=True)
    return fl.rename_id(cdc, "id", "load_id")


def snapshot_counts(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    per_row = b.select("load_id", F.col("ingest_time").alias("uploaded_at"),
                       fl.state_count(F.col("data")).alias("n"))
    return per_row.groupBy("load_id", "uploaded_at").agg(F.sum("n").cast("bigint").alias("n_states"))


def json_access(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    doc = F.from_json("data", "time bigint, states array<array<string>>")  # the payload is parsed once
    first = F.get(F.col("doc.states"), F.lit(0))
    return b.select("load_id", doc.alias("doc")).select(
        "load_id",
        F.col("doc.time").alias("snapshot_time"),
        F.get(first, F.lit(0)).alias("first_icao24"),
        F.get(first, F.lit(1)).alias("first_callsign"),
        F.size("doc.states").cast("bigint").alias("n_states"),
    )


def _tokens(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"])
    return ev.select("event_id", memo(("tokens",), _token_array))


def _token_array():
    e = F.col("event_id")
    s = lambda c: c.cast("string")
    toks = [
        s(e),
        F.concat(s(F.col("user_id")), F.lit("."), s(e % 100)),
        F.col("event_type"),
        F.concat(F.lit(" "), s(e % 300), F.lit(" ")),
        F.concat(F.lit("-"), s(e)),
        F.concat(s(e % 1000), F.lit("e2")),
        F.concat(s(e), F.lit("d")),
        s(e + F.lit(4294967290)),
        F.when(e % 3 == 0, "true").when(e % 3 == 1, "false").otherwise(""),
        F.when(e % 11 != 0, s(e % 512)),
        F.col("props"),
        F.concat(F.lit("."), s(e % 10)),
    ]
    arr = F.array(*[F.struct(F.lit(i + 1).alias("token_no"), t.alias("token")) for i, t in enumerate(toks)])
    return F.inline(arr)


def cast_lenient(spark, sf_dir):
    def cols():
        x = F.col("token")
        return [F.col("event_id"), F.col("token_no"), x,
                casts.f64_or_null(x).alias("f64"),
                casts.i32_or_null(x).alias("i32"),
                casts.u32_or_zero(x).alias("u32z"),
                casts.u8_or_zero(x).alias("u8z"),
                casts.to_bool(x).alias("bool_cast"),
                casts.to_bool(x, "uint8_or_zero").alias("bool_u8")]
    return _tokens(spark, sf_dir).select(*memo(("cast_lenient",), cols))


def latest_watermark(spark, sf_dir):
    # The newest upload_date folder holds the newest snapshot: one day is read.
    return lt.latest_by_watermark(bf.read_latest_day(spark, _mart_table(spark, sf_dir)))


def latest_rank(spark, sf_dir):
    # The folder whose zone holds the greatest load_id is the only one opened.
    return lt.latest_by_rank(bf.read_top_load(spark, _mart_table(spark, sf_dir)))


def snapshot_asof(spark, sf_dir):
    # Only the day of the snapshot that was latest at AS_OF is read.
    return lt.snapshot_as_of(bf.read_latest_day(spark, _mart_table(spark, sf_dir), until=P.AS_OF), P.AS_OF)


def hourly_prev(spark, sf_dir):
    # The range of position times picks folders by their zones; inside them it reaches the row groups.
    mart = bf.read_positions(spark, _mart_table(spark, sf_dir), *hr.hour_bounds(P.AS_OF))
    return hr.hourly_previous(mart, P.AS_OF)


def hourly_all(spark, sf_dir):
    return hr.hourly(_mart(spark, sf_dir))


def airline_hourly(spark, sf_dir):
    return hr.airline_hourly(_mart(spark, sf_dir))


def _served_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly gold table with the hours of ``P.DAY`` exported, as the hourly job leaves it."""
    gold = f"{work_dir(spark, 'gold_day')}/gold"
    start = datetime.combine(P.DAY, time())
    end = start + timedelta(days=1)
    sinks.export_hourly(hr.hourly(bf.read_positions(spark, _mart_table(spark, sf_dir), start, end), start, end), gold)
    return sinks.read_hourly(spark, gold)


def country_day(spark, sf_dir):
    return sv.country_day(_served_hours(spark, sf_dir), P.COUNTRY, P.DAY)


def country_day_total(spark, sf_dir):
    return sv.with_total(sv.country_day(_served_hours(spark, sf_dir), P.COUNTRY, P.DAY))


def day_labels(spark, sf_dir):
    """The day view under its display labels."""
    return sv.labelled(sv.country_day(_served_hours(spark, sf_dir), P.COUNTRY, P.DAY))


def countries(spark, sf_dir):
    return sv.countries(lt.latest_by_watermark(bf.read_latest_day(spark, _mart_table(spark, sf_dir))))


def live_points(spark, sf_dir):
    return sv.live_points(lt.latest_by_watermark(bf.read_latest_day(spark, _mart_table(spark, sf_dir))))


def _stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bf.read_mart(spark, _mart_table(spark, sf_dir))


def bronze_snapshots(spark, sf_dir):
    root = work_dir(spark, "bronze_snapshots")
    br.land_snapshots(fixtures.snapshot_parts(spark, sf_dir, P.STATES_PER_PART), f"{root}/landing")
    br.load_landing(spark, f"{root}/landing", f"{root}/bronze", order_by="path")
    return br.snapshot_sizes(br.read_bronze(spark, f"{root}/bronze"))


def sink_latest_roundtrip(spark, sf_dir):
    root = work_dir(spark, "sink_latest")
    mart_root = _mart_table(spark, sf_dir)
    then = bf.read_latest_day(spark, mart_root, until=P.AS_OF)  # both open the folders of one snapshot
    for snap in (lt.snapshot_as_of(then, P.AS_OF), lt.latest_by_watermark(bf.read_latest_day(spark, mart_root))):
        version = snap.agg(F.max("load_id")).first()[0]
        if version is not None:  # an empty snapshot is not exported
            sinks.export_latest(snap, f"{root}/gold_latest", version)
    return sinks.read_latest(spark, f"{root}/gold_latest")


def sink_hourly_roundtrip(spark, sf_dir):
    root = work_dir(spark, "sink_hourly")
    mart = _stored_mart(spark, sf_dir)
    sinks.export_hourly(hr.hourly(mart), f"{root}/gold_hourly")
    start, end = hr.hour_bounds(P.AS_OF)  # re-run one hour: only it is replaced
    sinks.export_hourly(hr.hourly(mart, start, end), f"{root}/gold_hourly")
    return sinks.read_hourly(spark, f"{root}/gold_hourly")


def backfill_no_dups(spark, sf_dir):
    root = work_dir(spark, "backfill")
    _bronze(spark, sf_dir).write.parquet(f"{root}/bronze")
    staged = spark.read.schema(schemas.BRONZE).parquet(f"{root}/bronze")
    bf.backfill(spark, staged, f"{root}/mart")
    bf.backfill(spark, staged, f"{root}/mart")  # manual re-run adds nothing
    return bf.read_mart(spark, f"{root}/mart")


def _stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'run_log')}/log"
    rows = fixtures.run_log_rows(spark, sf_dir)
    rl.append_log(rows.where(F.col("run_id") == "").drop("run_id"), path)  # before run_id existed
    rl.append_log(rows.where(F.col("run_id") != ""), path)
    return rl.read_log(spark, path)


def run_log_recent(spark, sf_dir):
    return rl.recent(_stored_log(spark, sf_dir))


def alerts(spark, sf_dir):
    return rl.alerts(_stored_log(spark, sf_dir))


# --- streaming ---------------------------------------------------------------

def _staged_bronze(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Fixture bronze written in the stored bronze layout (by ingest date)."""
    path = f"{root}/bronze"
    (_bronze(spark, sf_dir).withColumns({"source_file": F.lit(None).cast("string"),
                                         "ingest_date": F.to_date("ingest_time")})
     .write.partitionBy("ingest_date").parquet(path))
    return path


def _await(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_bronze(spark, sf_dir):
    root = work_dir(spark, "stream_bronze")
    br.land_snapshots(fixtures.snapshot_parts(spark, sf_dir, P.STATES_PER_PART), f"{root}/landing")
    _await(st.bronze_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt",
                            trigger="available_now", order_by="path"))
    return br.snapshot_sizes(read_stream_bronze(spark, f"{root}/bronze"))


def stream_flatten(spark, sf_dir):
    root = work_dir(spark, "stream_flatten")
    bronze = _staged_bronze(spark, sf_dir, root)
    _await(st.flatten_stream(spark, bronze, f"{root}/mart", f"{root}/ckpt", trigger="available_now"))
    return bf.read_mart(spark, f"{root}/mart")


def stream_hourly(spark, sf_dir):
    root = work_dir(spark, "stream_hourly")
    bf.backfill(spark, _bronze(spark, sf_dir), f"{root}/mart")
    _close_all_hours(spark, root)
    return sinks.read_hourly(spark, f"{root}/gold")


def _close_all_hours(spark: SparkSession, root: str) -> None:
    """Run the hourly stream over the mart under ``root``; the clock stands two hours after its newest upload."""
    newest = max((z.uploaded_at[1] for z in ix.zones(spark, f"{root}/mart") if z.uploaded_at), default="1970-01-01 00:00:00")
    st.advance_clock(spark, f"{root}/clock", datetime.fromisoformat(newest) + timedelta(hours=2))
    _await(st.hourly_stream(spark, f"{root}/mart", f"{root}/gold", f"{root}/ckpt", delay="10 minutes",
                            trigger="available_now", clock_root=f"{root}/clock"))


def stream_late_hours(spark, sf_dir):
    """A part of the reports arrives after its hours were exported; the late hours are found and redone."""
    root = work_dir(spark, "stream_late")
    mart = _mart(spark, sf_dir)
    is_late = F.pmod(F.xxhash64("icao24", "time_position"), F.lit(29)) == 0
    watch = lambda: _await(st.late_hours_stream(spark, f"{root}/mart", f"{root}/gold", f"{root}/late", f"{root}/late_ckpt",
                                                trigger="available_now", clock_root=f"{root}/clock"))
    bf.write_mart(mart.where(~is_late), f"{root}/mart")
    watch()  # nothing is exported yet, so nothing is late
    _close_all_hours(spark, root)
    bf.write_mart(mart.where(is_late), f"{root}/mart")
    watch()
    return sinks.read_hourly(spark, f"{root}/gold")


def mart_compacted(spark, sf_dir):
    """A stream of small micro-batches, its folders merged as it goes."""
    root = work_dir(spark, "mart_compacted")
    bronze = _staged_bronze(spark, sf_dir, root)
    files = len(spark.read.schema(br.BRONZE_STORED).parquet(bronze).inputFiles())
    _await(st.flatten_stream(spark, bronze, f"{root}/mart", f"{root}/ckpt", trigger="available_now",
                             max_files_per_trigger=max(1, files // 8), compact_every=3))
    ix.compact(spark, f"{root}/mart", fan=2)
    return bf.read_mart(spark, f"{root}/mart")


def mart_mixed_writers(spark, sf_dir):
    """Half of the snapshots by a batch job, all by a stream, then the batch again: each is in the mart once."""
    root = work_dir(spark, "mart_mixed")
    bronze = _staged_bronze(spark, sf_dir, root)
    whole = br.read_bronze(spark, bronze)
    bf.backfill(spark, whole.where("load_id % 2 = 0"), f"{root}/mart")
    _await(st.flatten_stream(spark, bronze, f"{root}/mart", f"{root}/ckpt", trigger="available_now"))
    bf.backfill(spark, whole, f"{root}/mart")
    return bf.read_mart(spark, f"{root}/mart")


def hourly_extremes(spark, sf_dir):
    """Means of measures far beyond any decimal: whole multiples of 2^80 and 2^-40."""
    big, small = F.lit(float(2 ** 80)), F.lit(2.0 ** -40)
    second = F.second("last_contact").cast("double")
    mart = _mart(spark, sf_dir).withColumns({"velocity": second * big, "baro_altitude": F.minute("last_contact").cast("double") * small + second})
    return hr.hourly(mart)


def json_first_raw(spark, sf_dir):
    """The first state vector of each payload as the text it has there."""
    raw = F.get(F.from_json("data", "states array<string>")["states"], F.lit(0))
    return _bronze(spark, sf_dir).select("load_id", raw.alias("first_raw"))


def sql_text(spark, sf_dir):
    """SQL text with a bound parameter to rows, their number taken on the way."""
    _mart(spark, sf_dir).createOrReplaceTempView(vw.MART_VIEW)
    rows, counted = sql_frame(spark, f"SELECT icao24, time_position FROM {vw.MART_VIEW} WHERE origin_country = :country",
                              {"country": P.COUNTRY})
    path = f"{work_dir(spark, 'sql_text')}/rows"
    rows.write.parquet(path)
    return (spark.read.schema(rows.schema).parquet(path).groupBy("icao24").agg(F.count(F.lit(1)).alias("reports"))
            .withColumn("n_rows", F.lit(counted.get["rows"])))


def served_views(spark, sf_dir):
    """The replaceable views: the latest flights by upload time, by rank, and one day of one country."""
    vw.register_views(spark, _stored_mart(spark, sf_dir), _served_hours(spark, sf_dir))
    latest = [spark.table(v).groupBy("origin_country").agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("view"), "origin_country", "n")
              for k, v in (("latest", vw.LATEST_VIEW), ("ranked", vw.LATEST_RANKED_VIEW))]
    day = vw.country_day_sql(spark, P.COUNTRY, P.DAY).agg(F.sum("flights").alias("n")).where("n IS NOT NULL")
    return latest[0].union(latest[1]).union(day.select(F.lit("day"), F.lit(P.COUNTRY), "n"))


def log_sample(spark, sf_dir):
    """One newest record of the run log."""
    newest = rl.recent(_stored_log(spark, sf_dir), 1)
    return newest.select("logged_at")


def stream_crash_log(spark, sf_dir):
    """A stream over the run log that fails at its first record above ERROR; what it leaves in the log."""
    root = work_dir(spark, "stream_crash")
    rl.append_log(fixtures.run_log_rows(spark, sf_dir), f"{root}/records")

    def fail(batch: DataFrame, batch_id: int) -> None:
        raise ValueError(f"records above ERROR: {batch.where(F.col('level') == 'CRITICAL').count()}")

    listener = rl.StreamRunLog(spark, f"{root}/log")
    spark.streams.addListener(listener)
    try:
        query = (spark.readStream.schema(schemas.RUN_LOG).parquet(f"{root}/records").writeStream.foreachBatch(fail)
                 .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # the end of a stream reaches listeners a moment later
    finally:
        spark.streams.removeListener(listener)
    log = rl.read_log(spark, f"{root}/log").where((F.col("run_id") == str(query.runId)) & (F.col("level") == "CRITICAL"))
    return log.select("level", F.regexp_extract("message", "(records above ERROR: [0-9]+)", 1).alias("message"))


def stream_latest(spark, sf_dir):
    root = work_dir(spark, "stream_latest")
    bronze = _staged_bronze(spark, sf_dir, root)
    _await(st.flatten_stream(spark, bronze, f"{root}/mart", f"{root}/ckpt_mart", trigger="available_now"))
    _await(st.latest_refresh_stream(spark, f"{root}/mart", f"{root}/gold", f"{root}/ckpt_gold",
                                    trigger="available_now"))
    return sinks.read_latest(spark, f"{root}/gold")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flatten_states": flatten_states,
    "flatten_strict": flatten_strict,
    "flatten_cdc": flatten_cdc,
    "snapshot_counts": snapshot_counts,
    "json_access": json_access,
    "cast_lenient": cast_lenient,
    "latest_watermark": latest_watermark,
    "latest_rank": latest_rank,
    "snapshot_asof": snapshot_asof,
    "hourly_prev": hourly_prev,
    "hourly_all": hourly_all,
    "airline_hourly": airline_hourly,
    "country_day": country_day,
    "country_day_total": country_day_total,
    "countries": countries,
    "live_points": live_points,
    "bronze_snapshots": bronze_snapshots,
    "sink_latest_roundtrip": sink_latest_roundtrip,
    "sink_hourly_roundtrip": sink_hourly_roundtrip,
    "backfill_no_dups": backfill_no_dups,
    "run_log_recent": run_log_recent,
    "alerts": alerts,
    "stream_bronze": stream_bronze,
    "stream_flatten": stream_flatten,
    "stream_hourly": stream_hourly,
    "stream_latest": stream_latest,
    "stream_late_hours": stream_late_hours,
    "stream_crash_log": stream_crash_log,
    "mart_compacted": mart_compacted,
    "mart_mixed_writers": mart_mixed_writers,
    "hourly_extremes": hourly_extremes,
    "json_first_raw": json_first_raw,
    "sql_text": sql_text,
    "served_views": served_views,
    "day_labels": day_labels,
    "log_sample": log_sample,
    **ingestion.QUERIES,
}
