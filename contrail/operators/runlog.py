"""Structured run log: records from Python logging land in a Parquet table.

``SparkLogHandler`` buffers the records of one run on the driver (a run emits
a handful) and appends them in one write. Reading merges the old layout
(without ``run_id``) with the new one; old rows read ``run_id = ''``.
Alerts are the records at ERROR or above with a mail-style subject.
"""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from contrail import schemas

# Alerting levels and the subject layout.
ALERT_LEVELS = ("ERROR", "CRITICAL")
SUBJECT_PREFIX = "] Flight pipeline: "
SUBJECT_CHARS = 80


def new_run_id() -> str:
    return str(uuid.uuid4())


class SparkLogHandler(logging.Handler):
    """Collects log records with a run id; ``flush_to`` appends them once."""

    def __init__(self, run_id: str | None = None):
        super().__init__()
        self.run_id = run_id or new_run_id()
        self.rows: list[tuple] = []

    def emit(self, record: logging.LogRecord) -> None:
        logged = datetime.fromtimestamp(record.created, tz=timezone.utc).replace(tzinfo=None, microsecond=0)
        self.rows.append((logged, record.levelname, record.getMessage(), record.name,
                          record.funcName, int(record.lineno), record.pathname, self.run_id))

    def flush_to(self, spark: SparkSession, path: str) -> int:
        n = len(self.rows)
        if n:
            append_log(spark.createDataFrame(self.rows, schemas.RUN_LOG), path)
            self.rows = []
        return n


class StreamRunLog(StreamingQueryListener):
    """Writes the beginning and the end of every stream into the run log.

    A stream that fails leaves a CRITICAL row with its message, one that stops
    in order an INFO row; ``run_id`` is the stream's own run. Rows are written
    as events arrive, each in one small append: a crash record waits for nothing.
    Register with ``spark.streams.addListener`` and remove when done.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path

    def _note(self, level: str, message: str, function: str, run_id) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        row = (now, level, message, "contrail.streams", function, 0, __name__, str(run_id))
        append_log(self.spark.createDataFrame([row], schemas.RUN_LOG), self.path)

    def onQueryStarted(self, event) -> None:
        self._note("INFO", f"stream {event.name or event.id} has begun", "onQueryStarted", event.runId)

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is None:
            self._note("INFO", f"stream {event.id} has ended", "onQueryTerminated", event.runId)
        else:
            self._note("CRITICAL", f"stream {event.id} failed: {event.exception}", "onQueryTerminated", event.runId)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All log rows; files written before ``run_id`` existed read ''."""
    df = spark.read.schema(schemas.RUN_LOG).parquet(path)  # a column a file lacks reads NULL
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RUN_LOG.fields[:-1]],
                     F.coalesce(F.col("run_id"), F.lit("")).alias("run_id"))


def recent(log: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest first; with a limit Spark plans a top-k, not a full sort."""
    out = log.orderBy(F.col("logged_at").desc())
    return out.limit(limit) if limit else out


def alerts(log: DataFrame) -> DataFrame:
    """Records that would be mailed, with their subject line."""
    subject = F.concat(F.lit("["), F.col("level"), F.lit(SUBJECT_PREFIX),
                       F.substring("message", 1, SUBJECT_CHARS))
    return log.where(F.col("level").isin(*ALERT_LEVELS)).withColumn("subject", subject)
