"""Each streaming job equals its batch twin."""

from contrail.operators import backfill as bf
from contrail.operators import hourly as hr
from contrail.operators import latest as lt
from contrail.plans import catalog
from contrail.sources import bronze as br
from contrail.sources import fixtures, sinks
from contrail import streaming as st
from contrail.streaming.jobs import read_stream_bronze
from tests.conftest import SF_SMALL, sorted_rows


def _rows(df):
    return sorted_rows(df)


def test_stream_flatten_equals_batch_and_is_incremental(spark, tmp_dir):
    bronze = catalog._staged_bronze(spark, SF_SMALL, tmp_dir)
    q = st.flatten_stream(spark, bronze, f"{tmp_dir}/mart", f"{tmp_dir}/ckpt", trigger="available_now",
                          max_files_per_trigger=3)
    catalog._await(q)
    batch = catalog._mart(spark, SF_SMALL)
    assert _rows(bf.read_mart(spark, f"{tmp_dir}/mart")) == _rows(batch)
    # A restart on the same checkpoint finds nothing new: no duplicates.
    catalog._await(st.flatten_stream(spark, bronze, f"{tmp_dir}/mart", f"{tmp_dir}/ckpt",
                                     trigger="available_now"))
    assert bf.read_mart(spark, f"{tmp_dir}/mart").count() == batch.count()
    # The latest refresh stream serves the batch latest view.
    catalog._await(st.latest_refresh_stream(spark, f"{tmp_dir}/mart", f"{tmp_dir}/gold", f"{tmp_dir}/ckpt2",
                                            trigger="available_now"))
    assert _rows(sinks.read_latest(spark, f"{tmp_dir}/gold")) == _rows(lt.latest_by_watermark(batch))


def test_stream_hourly_equals_batch(spark, tmp_dir):
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), f"{tmp_dir}/mart")
    catalog._close_all_hours(spark, tmp_dir)
    got = sinks.read_hourly(spark, f"{tmp_dir}/gold")
    assert _rows(got) == _rows(hr.hourly(bf.read_mart(spark, f"{tmp_dir}/mart")))


def test_stream_bronze_numbers_like_batch(spark, tmp_dir):
    parts = fixtures.snapshot_parts(spark, SF_SMALL)
    br.land_snapshots(parts, f"{tmp_dir}/landing")
    catalog._await(st.bronze_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/sb", f"{tmp_dir}/ckpt",
                                    trigger="available_now", order_by="path"))
    br.load_landing(spark, f"{tmp_dir}/landing", f"{tmp_dir}/bb", order_by="path")
    a = br.snapshot_sizes(read_stream_bronze(spark, f"{tmp_dir}/sb"))
    b = br.snapshot_sizes(br.read_bronze(spark, f"{tmp_dir}/bb"))
    assert _rows(a) == _rows(b)


def test_latest_refresh_picks_up_parts_in_later_batches(spark, tmp_dir):
    # One state per part, spread over several files, read a few files per
    # batch: the newest snapshot's parts can land in different batches, and
    # the served snapshot must still be whole.
    from pyspark.sql import functions as F
    parts = fixtures.snapshot_parts(spark, SF_SMALL, states_per_part=1)
    (parts.drop("part").withColumns({"source_file": F.lit(None).cast("string"),
                                     "ingest_date": F.to_date("ingest_time")})
     .repartition(4).write.partitionBy("ingest_date").parquet(f"{tmp_dir}/bronze"))
    catalog._await(st.flatten_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/mart", f"{tmp_dir}/c1",
                                     trigger="available_now"))
    catalog._await(st.latest_refresh_stream(spark, f"{tmp_dir}/mart", f"{tmp_dir}/gold", f"{tmp_dir}/c2",
                                            trigger="available_now", max_files_per_trigger=10))
    want = lt.latest_by_watermark(catalog._mart(spark, SF_SMALL))
    assert _rows(sinks.read_latest(spark, f"{tmp_dir}/gold")) == _rows(want)


def test_late_report_dropped_by_stream_and_recovered_by_hour_rerun(spark, tmp_dir):
    import datetime as dt
    from pyspark.sql import functions as F
    mart_root = f"{tmp_dir}/mart"
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), mart_root)
    catalog._close_all_hours(spark, tmp_dir)
    before = {tuple(r[:3]): r["fly_count"] for r in sinks.read_hourly(spark, f"{tmp_dir}/gold").collect()}
    # A late report for an hour that was already emitted, from a new aircraft.
    mart = bf.read_mart(spark, mart_root).where("on_ground = false")
    one = mart.where(F.col("time_position").isNotNull()).orderBy("time_position").first()
    late = mart.where(F.col("time_position") == one["time_position"]).limit(1).withColumn("icao24", F.lit("ffffff"))
    bf.write_mart(late, mart_root)
    catalog._close_all_hours(spark, tmp_dir)
    key = (one["origin_country"], one["time_position"].date(), one["time_position"].hour)
    after_stream = {tuple(r[:3]): r["fly_count"] for r in sinks.read_hourly(spark, f"{tmp_dir}/gold").collect()}
    assert after_stream == before  # late: never counted by the stream
    start = dt.datetime.combine(key[1], dt.time(key[2]))
    sinks.export_hourly(hr.hourly(bf.read_mart(spark, mart_root), start, start + dt.timedelta(hours=1)),
                        f"{tmp_dir}/gold")
    fixed = {tuple(r[:3]): r["fly_count"] for r in sinks.read_hourly(spark, f"{tmp_dir}/gold").collect()}
    assert fixed[key] == before[key] + 1
    assert {k: v for k, v in fixed.items() if k[1:] != key[1:]} == {k: v for k, v in before.items() if k[1:] != key[1:]}


def test_landing_to_mart_fully_streaming(spark, tmp_dir):
    br.land_snapshots(fixtures.snapshot_parts(spark, SF_SMALL), f"{tmp_dir}/landing")
    catalog._await(st.bronze_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/c1",
                                    trigger="available_now", order_by="path"))
    catalog._await(st.flatten_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/mart", f"{tmp_dir}/c2",
                                     trigger="available_now"))
    got = bf.read_mart(spark, f"{tmp_dir}/mart").drop("load_id")
    want = catalog._mart(spark, SF_SMALL).drop("load_id")  # ids differ: path rank vs hour number
    assert _rows(got) == _rows(want)


def test_hourly_stream_state_is_keyed_by_aircraft(spark, tmp_dir):
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), f"{tmp_dir}/mart")
    q = st.hourly_stream(spark, f"{tmp_dir}/mart", f"{tmp_dir}/gold", f"{tmp_dir}/ckpt",
                         trigger="available_now")
    catalog._await(q)
    plan = q._jsq.explainInternal(False)  # physical plan of the last micro-batch
    assert plan.count("StateStoreSave") == 2, plan  # two chained stateful aggregations
    first = plan[plan.rindex("StateStoreSave"):]
    assert "icao24" in first.splitlines()[0]  # the inner one is keyed by aircraft
    assert "collect_set" not in plan
