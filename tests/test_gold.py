"""Latest / as-of views, hourly analytics, serving reads, sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.operators import backfill as bf
from contrail.operators import hourly as hr
from contrail.operators import latest as lt
from contrail.operators import serving as sv
from contrail.sources import fixtures, sinks
from tests.conftest import SF_SMALL, sorted_rows

AS_OF = dt.datetime(2024, 1, 15, 12, 30)


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("mart"))
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), f"{root}/mart")
    return bf.read_mart(spark, f"{root}/mart")


def _rows(df):
    return sorted_rows(df)


def test_rank_latest_equals_watermark_latest(mart):
    a, b = lt.latest_by_rank(mart), lt.latest_by_watermark(mart)
    assert _rows(a) == _rows(b) and len(_rows(a)) > 0
    assert "indx" in lt.latest_by_rank(mart, keep_marker=True).columns
    assert "max_date" in lt.latest_by_watermark(mart, keep_marker=True).columns


def test_as_of_is_the_latest_at_that_time(mart):
    snap = lt.snapshot_as_of(mart, AS_OF)
    times = {r[0] for r in snap.select("uploaded_at").distinct().collect()}
    assert len(times) == 1 and max(times) <= AS_OF
    newer = mart.where((F.col("uploaded_at") > max(times)) & (F.col("uploaded_at") <= F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz")))
    assert newer.count() == 0


def test_latest_plan_has_no_global_sort(mart):
    plan = lt.latest_by_rank(mart)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:  # only per-task partial maxima travel there
            assert "partial_max" in lines[i + 1], plan


def test_hourly_prev_pushes_range_to_parquet(mart):
    q = hr.hourly_previous(mart, AS_OF)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "time_position" in plan.split("PushedFilters")[1][:400]
    assert "EvalPython" not in plan
    start, end = hr.hour_bounds(AS_OF)
    assert (start, end) == (dt.datetime(2024, 1, 15, 11), dt.datetime(2024, 1, 15, 12))
    for r in q.collect():
        assert r["fly_date"] == dt.date(2024, 1, 15) and r["fly_hour"] == 11


def test_hourly_sum_of_hours_equals_all(mart):
    full = hr.hourly(mart)
    hours = [r for r in full.select("fly_date", "fly_hour").distinct().collect()][:5]
    parts = None
    for r in hours:
        start = dt.datetime.combine(r["fly_date"], dt.time(r["fly_hour"]))
        one = hr.hourly(mart, start, start + dt.timedelta(hours=1))
        parts = one if parts is None else parts.unionByName(one)
    keys = full.join(parts.select("fly_date", "fly_hour").distinct(), ["fly_date", "fly_hour"], "left_semi")
    assert _rows(keys.select(*full.columns)) == _rows(parts.select(*full.columns))


def test_day_total_is_not_a_rollup(spark):
    rows = spark.createDataFrame(
        [(dt.date(2024, 1, 15), 1, 3, 100.0, 10.0), (dt.date(2024, 1, 15), 2, 5, 201.0, 20.01)],
        "fly_date date, fly_hour int, flights long, avg_altitude double, avg_velocity double")
    out = {r["fly_date"]: r for r in sv.with_total(rows).collect()}
    t = out["Total"]
    assert t["fly_hour"] == "" and t["flights"] == 8
    assert t["avg_altitude"] == 150.5 and t["avg_velocity"] == 15.0  # 15.005 rounds half-even on binary
    empty = sv.with_total(rows.where("false"))
    assert empty.count() == 0
    assert sv.labelled(sv.with_total(rows)).columns == list(sv.DAY_LABELS.values())


def test_live_points_country_filter(mart):
    latest = lt.latest_by_watermark(mart)
    pts = sv.live_points(latest)
    assert pts.where(F.col("latitude").isNull() | F.col("longitude").isNull()).count() == 0
    country = pts.first()["origin_country"]
    one = sv.live_points(latest, country).collect()
    assert one and all(r["origin_country"] == country for r in one)
    assert sv.live_points(latest, "x' OR '1'='1").count() == 0  # bound literal, inert


def test_sinks_roundtrip_and_hour_rerun(spark, mart, tmp_dir):
    gold = f"{tmp_dir}/hourly"
    full = hr.hourly(mart)
    sinks.export_hourly(full, gold)
    start, end = hr.hour_bounds(AS_OF)
    sinks.export_hourly(hr.hourly(mart, start, end), gold)
    assert _rows(sinks.read_hourly(spark, gold)) == _rows(full)

    latest_root = f"{tmp_dir}/latest"
    sinks.export_latest(lt.snapshot_as_of(mart, AS_OF), latest_root, 1)
    sinks.export_latest(lt.latest_by_watermark(mart), latest_root, 2)
    assert _rows(sinks.read_latest(spark, latest_root)) == _rows(lt.latest_by_watermark(mart))


def test_backfill_rerun_adds_nothing(spark, tmp_dir):
    staged = fixtures.snapshot_bronze(spark, SF_SMALL)
    bf.backfill(spark, staged, f"{tmp_dir}/m")
    n = bf.read_mart(spark, f"{tmp_dir}/m").count()
    bf.backfill(spark, staged, f"{tmp_dir}/m")
    assert bf.read_mart(spark, f"{tmp_dir}/m").count() == n == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_views_and_parameterised_sql(spark, mart):
    from contrail.operators import views
    hourly = hr.hourly(mart)
    views.register_views(spark, mart, hourly)
    assert _rows(spark.table(views.LATEST_VIEW)) == _rows(lt.latest_by_watermark(mart))
    assert _rows(spark.table(views.LATEST_RANKED_VIEW)) == _rows(lt.latest_by_rank(mart))
    day = hourly.first()
    a = views.country_day_sql(spark, day["origin_country"], day["fly_date"])
    b = sv.country_day(hourly, day["origin_country"], day["fly_date"])
    assert _rows(a) == _rows(b) and a.count() > 0
    assert views.country_day_sql(spark, "x' OR '1'='1", day["fly_date"]).count() == 0


def test_latest_day_reader_prunes_to_one_day(spark, tmp_dir):
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), f"{tmp_dir}/m")
    full = bf.read_mart(spark, f"{tmp_dir}/m")
    day = bf.read_latest_day(spark, f"{tmp_dir}/m")
    assert _rows(lt.latest_by_watermark(day)) == _rows(lt.latest_by_watermark(full))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(upload_date" in plan


def test_sql_frame_counts_rows_while_running(spark):
    from contrail.sources.tables import sql_frame
    df, obs = sql_frame(spark, "SELECT id FROM range(10) WHERE id < :n", {"n": 7})
    assert df.count() == 7 and obs.get["rows"] == 7


def test_batch_jobs_export_and_log(spark, tmp_dir):
    from contrail.operators import runlog
    from contrail.plans import jobs
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), f"{tmp_dir}/m")
    mart = bf.read_mart(spark, f"{tmp_dir}/m")
    n = jobs.export_previous_hour(spark, f"{tmp_dir}/m", f"{tmp_dir}/hourly", AS_OF, f"{tmp_dir}/log")
    assert n == hr.hourly_previous(mart, AS_OF).count()
    v = jobs.export_latest_snapshot(spark, f"{tmp_dir}/m", f"{tmp_dir}/latest", f"{tmp_dir}/log")
    assert v == lt.latest_by_watermark(mart).first()["load_id"]
    assert _rows(sinks.read_latest(spark, f"{tmp_dir}/latest")) == _rows(lt.latest_by_watermark(mart))
    logged = runlog.read_log(spark, f"{tmp_dir}/log")
    assert logged.where("message LIKE '%exported, rows: %' OR message LIKE 'latest snapshot is now %'").count() == 2
    assert logged.select("run_id").distinct().count() == 2


def test_as_of_reads_one_day(spark, tmp_dir):
    bf.backfill(spark, fixtures.snapshot_bronze(spark, SF_SMALL), f"{tmp_dir}/m")
    full = bf.read_mart(spark, f"{tmp_dir}/m")
    for as_of in (AS_OF, dt.datetime(2024, 1, 15, 0, 30), dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2030, 1, 1)):
        day = bf.read_latest_day(spark, f"{tmp_dir}/m", until=as_of)
        assert _rows(lt.snapshot_as_of(day, as_of)) == _rows(lt.snapshot_as_of(full, as_of)), as_of


def test_prune_keeps_newest_versions(spark, mart, tmp_dir):
    root = f"{tmp_dir}/latest"
    snap = lt.latest_by_watermark(mart)
    for v in range(1, 6):
        sinks.export_latest(snap, root, v)
    assert sinks.prune_versions(spark, root, keep=2) == 3
    from contrail.sources import fs
    assert sorted(fs.list_dirs(spark, root)) == [f"version={4:020d}", f"version={5:020d}"]
    assert _rows(sinks.read_latest(spark, root)) == _rows(snap)
    assert sinks.prune_versions(spark, root, keep=2) == 0
