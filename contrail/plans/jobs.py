"""The pipeline's batch entry points, ready to schedule.

* ``export_previous_hour``: hourly analytics of the previous complete hour
  (relative to ``as_of``, default now in UTC) into the hourly gold folder;
  re-running an hour replaces just that hour.
* ``export_latest_snapshot``: the newest snapshot into a new version of the
  latest gold folder (readers switch once the version is committed).

Both log through the run log (one append per run, with a run id) when a log
path is given; errors are logged at ERROR and re-raised.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from contrail.operators import backfill as bf
from contrail.operators import hourly as hr
from contrail.operators import latest as lt
from contrail.operators.runlog import SparkLogHandler
from contrail.sources import sinks

log = logging.getLogger("contrail.jobs")


def _run(spark: SparkSession, log_path: str | None, body):
    handler = SparkLogHandler()
    log.addHandler(handler)
    log.setLevel(logging.INFO)
    try:
        log.info("run %s begins", handler.run_id)
        return body()
    except Exception as e:  # logged for alerting, then re-raised
        log.error("the job stopped: %s", e)
        raise
    finally:
        log.removeHandler(handler)
        if log_path:
            handler.flush_to(spark, log_path)


def export_previous_hour(spark: SparkSession, mart_root: str, gold_root: str,
                         as_of: datetime | None = None, log_path: str | None = None) -> int:
    """Returns the number of (country, hour) rows written."""
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)

    def body():
        start, end = hr.hour_bounds(as_of)
        rows = hr.hourly(bf.read_positions(spark, mart_root, start, end), start, end)
        sinks.export_hourly(rows, gold_root)
        n = sinks.read_hourly(spark, gold_root).where(
            (F.col("fly_date") == F.lit(start.date().isoformat()).cast("date"))
            & (F.col("fly_hour") == start.hour)).count()
        log.info("hour %s exported, rows: %d", start.isoformat(sep=" "), n)
        return n
    return _run(spark, log_path, body)


def export_latest_snapshot(spark: SparkSession, mart_root: str, gold_root: str,
                           log_path: str | None = None, keep_versions: int = 24) -> int | None:
    """Returns the exported version (the snapshot's load_id), or None if the mart is empty.

    After a successful export only the newest ``keep_versions`` versions are
    kept (24 = two hours at a 5-minute cadence), so readers' listing stays small.
    """
    def body():
        latest = lt.latest_by_watermark(bf.read_latest_day(spark, mart_root))
        version = latest.agg(F.max("load_id")).first()[0]
        if version is None:
            log.warning("no snapshot to export")
            return None
        path = sinks.export_latest(latest, gold_root, version)
        pruned = sinks.prune_versions(spark, gold_root, keep_versions)
        log.info("latest snapshot is now %s; old versions removed: %d", path, pruned)
        return version
    return _run(spark, log_path, body)
