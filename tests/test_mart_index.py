"""Zone map, pruned reads, compaction, hours closed by the clock, late hours, stream crash records."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from contrail import schemas
from contrail import streaming as st
from contrail.operators import backfill as bf
from contrail.operators import hourly as hr
from contrail.operators import latest as lt
from contrail.operators import mart_index as ix
from contrail.operators import runlog
from contrail.plans import catalog
from contrail.sources import manifest, sinks
from tests.conftest import SF_SMALL, sorted_rows


@pytest.fixture(scope="module")
def flights(spark):
    return catalog._mart(spark, SF_SMALL).cache()


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_top_load_opens_one_folder(spark, flights, tmp_dir):
    bf.write_mart(flights, tmp_dir)
    found = ix.zones(spark, tmp_dir)
    assert len(found) > 5 and sum(z.rows for z in found) == flights.count()
    ranked = lt.latest_by_rank(bf.read_top_load(spark, tmp_dir))
    assert sorted_rows(ranked) == sorted_rows(lt.latest_by_rank(flights))
    day = ix.with_top_load(found)[0].upload_date
    opened = {os.path.basename(os.path.dirname(os.path.dirname(f))) for f in bf.read_top_load(spark, tmp_dir).inputFiles()}
    assert opened == {f"upload_date={day}"} and day in plan_of(ranked).split("PartitionFilters")[1]


def test_hour_range_becomes_a_date_range(spark, flights, tmp_dir):
    bf.write_mart(flights, tmp_dir)
    start = flights.agg(F.date_trunc("hour", F.max("time_position")).cast("timestamp_ntz")).first()[0]
    pruned = bf.read_positions(spark, tmp_dir, start, start + dt.timedelta(hours=1))
    got = hr.hourly(pruned, start, start + dt.timedelta(hours=1))
    assert sorted_rows(got) == sorted_rows(hr.hourly(flights, start, start + dt.timedelta(hours=1))) and got.count() > 0
    assert len(pruned.inputFiles()) < len(bf.read_mart(spark, tmp_dir).inputFiles()) / 5
    plan = plan_of(got)
    assert "upload_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(time_position" in plan and "LessThan(time_position" in plan
    assert bf.read_positions(spark, tmp_dir, dt.datetime(1990, 1, 1), dt.datetime(1990, 1, 2)).count() == 0


def test_folders_of_a_stopped_write_are_not_read(spark, flights, tmp_dir, monkeypatch):
    bf.write_mart(flights.where("load_id % 2 = 0"), tmp_dir)

    def stop(*a):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(ix, "register", stop)
        with pytest.raises(RuntimeError):
            bf.write_mart(flights.where("load_id % 2 = 1"), tmp_dir)
    assert bf.read_mart(spark, tmp_dir).count() == flights.where("load_id % 2 = 0").count()
    bf.write_mart(flights.where("load_id % 2 = 1"), tmp_dir)
    assert sorted_rows(bf.read_mart(spark, tmp_dir)) == sorted_rows(flights)
    assert bf.read_mart(spark, f"{tmp_dir}/none").count() == 0


def test_as_of_reads_find_the_snapshot(spark, flights, tmp_dir):
    for k in range(3):  # every snapshot's rows in several folders
        bf.write_mart(flights.where(F.pmod(F.xxhash64("icao24"), F.lit(3)) == k), tmp_dir)
    times = [r[0] for r in flights.select("uploaded_at").distinct().orderBy("uploaded_at").collect()]
    for at in (times[0], times[len(times) // 2] + dt.timedelta(minutes=7), times[-1]):
        assert sorted_rows(lt.snapshot_as_of(bf.read_latest_day(spark, tmp_dir, until=at), at)) == sorted_rows(lt.snapshot_as_of(flights, at))
    assert sorted_rows(lt.latest_by_watermark(bf.read_latest_day(spark, tmp_dir))) == sorted_rows(lt.latest_by_watermark(flights))
    assert bf.read_latest_day(spark, tmp_dir, until=times[0] - dt.timedelta(days=9)).count() == 0


def test_many_micro_batches_leave_few_folders(spark, flights, tmp_dir):
    one = spark.createDataFrame(flights.limit(30).collect(), schemas.MART)
    one = one.withColumn("uploaded_at", F.lit("2024-01-05 01:00:00").cast("timestamp_ntz"))
    n, fan = 24, 3
    want = 0
    for b in range(n):
        bf.write_mart_batch(one.withColumn("load_id", F.lit(b).cast("long")).coalesce(1), tmp_dir, f"abc-{b}")
        want += 30
        if b % 4 == 3:
            planned = bf.read_mart(spark, tmp_dir)  # a plan made before the merge goes on after it
            ix.compact(spark, tmp_dir, fan=fan, grace=dt.timedelta(0))
            assert planned.count() == want
            got = bf.read_mart(spark, tmp_dir).groupBy("load_id").count().collect()
            assert sorted((r[0], r[1]) for r in got) == [(i, 30) for i in range(b + 1)]
    ix.compact(spark, tmp_dir, fan=fan, grace=dt.timedelta(0))
    found = ix.zones(spark, tmp_dir)
    assert len(found) <= 3 * fan and {z.origin for z in found} == {"stream"} and max(z.tier for z in found) >= 2
    ix.compact(spark, tmp_dir, fan=100, grace=dt.timedelta(0))  # what was merged away goes in a later compaction
    assert sorted(os.listdir(f"{tmp_dir}/upload_date=2024-01-05")) == sorted(f"writer={z.writer}" for z in found)
    assert ix.with_top_load(found)[0].load_id[1] == n - 1


def test_writers_add_to_the_index_past_each_other(spark, flights, tmp_dir, monkeypatch):
    publish, calls = manifest.publish, []
    part = flights.where("load_id % 7 = 0")

    def overtaken(spark_, root, seen, state):
        if not calls:
            calls.append(1)
            bf.write_mart(flights.where("load_id % 7 = 1"), tmp_dir)
        return publish(spark_, root, seen, state)
    monkeypatch.setattr(ix.manifest, "publish", overtaken)
    bf.write_mart(part, tmp_dir)
    assert sorted_rows(bf.read_mart(spark, tmp_dir)) == sorted_rows(flights.where("load_id % 7 IN (0, 1)"))


def test_streams_pass_over_merged_folders(spark, flights, tmp_dir):
    mart = f"{tmp_dir}/mart"
    for k in range(3):
        bf.write_mart(flights.where(F.pmod(F.xxhash64("icao24"), F.lit(3)) == k), mart)
    catalog._close_all_hours(spark, tmp_dir)
    want = sorted_rows(hr.hourly(flights))
    assert sorted_rows(sinks.read_hourly(spark, f"{tmp_dir}/gold")) == want
    assert ix.compact(spark, mart, fan=2) > 0
    catalog._close_all_hours(spark, tmp_dir)
    assert sorted_rows(sinks.read_hourly(spark, f"{tmp_dir}/gold")) == want
    assert "__heartbeat__" not in {r[0] for r in bf.read_mart(spark, mart).select("origin_country").distinct().collect()}


def test_late_report_changes_exactly_its_hour(spark, flights, tmp_dir):
    mart = f"{tmp_dir}/mart"
    watch = lambda: catalog._await(st.late_hours_stream(spark, mart, f"{tmp_dir}/gold", f"{tmp_dir}/late", f"{tmp_dir}/lck",
                                                        trigger="available_now", clock_root=f"{tmp_dir}/clock"))
    bf.write_mart(flights, mart)
    watch()
    catalog._close_all_hours(spark, tmp_dir)
    before = {tuple(r[:3]): tuple(r) for r in sinks.read_hourly(spark, f"{tmp_dir}/gold").collect()}
    files = {f for f in sinks.read_hourly(spark, f"{tmp_dir}/gold").inputFiles()}
    seen = flights.where("on_ground = false AND time_position IS NOT NULL").orderBy("time_position").first()
    late = flights.where((F.col("time_position") == seen["time_position"]) & ~F.col("on_ground")).limit(1)
    late = late.withColumns({"icao24": F.lit("ffffff"), "uploaded_at": F.col("uploaded_at") + F.expr("INTERVAL 2 HOURS")})
    bf.write_mart(late, mart)
    watch()
    key = (seen["origin_country"], seen["time_position"].date(), seen["time_position"].hour)
    after = {tuple(r[:3]): tuple(r) for r in sinks.read_hourly(spark, f"{tmp_dir}/gold").collect()}
    assert after[key][3] == before[key][3] + 1
    assert {k: v for k, v in after.items() if k != key} == {k: v for k, v in before.items() if k != key}
    new = {f for f in sinks.read_hourly(spark, f"{tmp_dir}/gold").inputFiles()} - files
    assert len(new) == 1 and f"fly_date={key[1]}/fly_hour={key[2]}/" in new.pop()  # no other hour was written
    noted = [tuple(r) for r in spark.read.schema("fly_date date, fly_hour int, reports long").parquet(f"{tmp_dir}/late").select("fly_date", "fly_hour", "reports").collect()]
    assert noted == [(key[1], key[2], 1)]
    # An hour without any report so far is closed too: a report for it is late and makes its hour.
    empty = late.withColumns({"time_position": F.lit("2020-02-02 02:20:00").cast("timestamp_ntz"), "load_id": F.col("load_id") + 1})
    bf.write_mart(empty, mart)
    watch()
    assert sinks.read_hourly(spark, f"{tmp_dir}/gold").where("fly_date = DATE'2020-02-02'").select("fly_hour", "fly_count").collect() == [(2, 1)]


def test_failing_stream_leaves_a_critical_row(spark, flights, tmp_dir):
    bf.write_mart(flights, f"{tmp_dir}/mart")

    def fail(batch, batch_id):
        raise ValueError("no more")
    listener = runlog.StreamRunLog(spark, f"{tmp_dir}/log")
    spark.streams.addListener(listener)
    try:
        q = (spark.readStream.schema(ix.MART_STORED).parquet(f"{tmp_dir}/mart").writeStream.foreachBatch(fail)
             .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
        with pytest.raises(StreamingQueryException):
            q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    rows = runlog.read_log(spark, f"{tmp_dir}/log").where(F.col("run_id") == str(q.runId)).collect()
    assert sorted(r["level"] for r in rows) == ["CRITICAL", "INFO"]
    assert any("no more" in r["message"] for r in rows if r["level"] == "CRITICAL")
    assert runlog.alerts(runlog.read_log(spark, f"{tmp_dir}/log")).count() == 1
