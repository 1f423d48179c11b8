"""The registered queries of file ingestion, and their SQL twins.

Each writes the files it ingests from the driver tables, then ingests them the
way a scheduled job would, and pays for its own runs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from contrail.session import work_dir
from contrail.sources import fixtures
from contrail.sources import ingest as ig
from contrail.sources.fixtures import BROKEN_ORDERS_PER_FILE, ORDERS_PER_FILE
from contrail.sources.tables import read_table

INGEST_TARGET = "external_storage.orders_stage"
ORDERS_TARGET = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])
STAGE_TARGET = T.StructType([T.StructField("load_id", T.LongType()), T.StructField("ingest_time", T.TimestampNTZType()),
                             T.StructField("data", T.StringType())])
RUN_TIMES = [datetime(2026, 1, 1, 0, 0, i) for i in range(3)]


class Area:
    """A folder of files, a target table and a ledger of one query run."""

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType = ORDERS_TARGET):
        root = work_dir(spark, name)
        self.spark, self.schema = spark, schema
        self.src, self.target, self.ledger = f"{root}/src", f"{root}/target", f"{root}/ledger"

    def load(self, run: int = 0, **options) -> tuple[int, int, int]:
        columns = [c for c in self.schema.names if c not in options.get("defaults", {})]
        return tuple(ig.ingest_files(self.spark, INGEST_TARGET, self.schema, columns, self.src, self.target, self.ledger,
                                     now=RUN_TIMES[run], **options).first())

    def rows(self) -> DataFrame:
        return ig.read_target(self.spark, self.target, self.ledger, self.schema)

    def records(self) -> DataFrame:
        return ig.read_ledger(self.spark, self.ledger)

    def three_runs(self, sf_dir: str, runs: int = 3) -> list[tuple]:
        """Run 1 loads; run 2 skips good files and retries the bad one; run 3
        sees rewritten ndjson files (new etag) and appends them again."""
        out, before = [], 0
        for i in range(runs):
            if i != 1:
                fixtures.ingest_source_files(self.spark, sf_dir, self.src, rewrite=i == 2)
            counts = self.load(i)
            after = self.rows().count()
            out.append((i + 1, *counts, after - before))
            before = after
        return out


def _rel_key(col: str = "file_key"):
    rel = F.regexp_extract(F.col(col), r"^.*/src/(.*)$", 1)  # after the last /src/
    return F.regexp_replace(rel, r"part-[^/]+\.parquet$", "part.parquet")


def ingest_listing(spark, sf_dir):
    root = work_dir(spark, "ingest_listing")
    fixtures.ingest_source_files(spark, sf_dir, f"{root}/src")
    listed = ig.list_files(spark, f"{root}/src")  # the tree is listed once
    wanted = [("all", "json"), ("all", "ndjson"), ("all", "csv"), ("all", "parquet")]
    wanted += [(t, e) for t in ("json", " .CSV", "parquet") for e in ig.FORMATS if ig.takes(t, e)]
    kinds = spark.createDataFrame(wanted, "file_type string, ext string")
    return listed.groupBy("ext").agg(F.count("*").alias("n_files")).join(F.broadcast(kinds), "ext").select("file_type", "ext", "n_files")


def ingest_formats(spark, sf_dir):
    area = Area(spark, "ingest_formats")
    area.three_runs(sf_dir, runs=1)
    return area.rows()


def ingest_summary(spark, sf_dir):
    runs = Area(spark, "ingest_summary").three_runs(sf_dir)
    return spark.createDataFrame(runs, "run int, files_processed int, files_skipped int, files_failed int, rows_added long")


def ingest_ledger_skip(spark, sf_dir):
    area = Area(spark, "ingest_ledger_skip")
    area.three_runs(sf_dir, runs=2)
    done = ig.current_ledger(area.records()).where(F.col("status") == ig.SUCCESS)
    listed = ig.list_files(spark, area.src).withColumn("target_table", F.lit(INGEST_TARGET))
    return listed.join(done, ["target_table", "file_key", "etag"], "left_semi").select(_rel_key().alias("file_key"))


def ingest_failures(spark, sf_dir):
    area = Area(spark, "ingest_failures")
    area.three_runs(sf_dir)
    return (area.records().where(F.col("status") == ig.FAILED)
            .groupBy(_rel_key().alias("file_key"), "error_message").agg(F.count("*").alias("n_attempts")))


def ledger_current(spark, sf_dir):
    area = Area(spark, "ledger_current")
    area.three_runs(sf_dir)
    return (ig.current_ledger(area.records()).groupBy(_rel_key().alias("file_key"), "status")
            .agg(F.count("*").alias("n_etags")))


def ingest_csv_headers(spark, sf_dir):
    """Files of unlike headers, with quoted newlines, in many blocks a file."""
    area = Area(spark, "ingest_csv_headers")
    fixtures.csv_header_files(spark, sf_dir, area.src)
    area.load(file_type="csv", csv_block_bytes=64 << 10)
    return area.rows()


def ingest_mixed_failures(spark, sf_dir):
    """Good, hidden, empty, cut, damaged and ill-typed files in one folder; ``rows_loaded`` is of the whole target."""
    area = Area(spark, "ingest_mixed_failures")
    fixtures.broken_files(spark, sf_dir, area.src)
    area.load()
    reason = F.regexp_extract("error_message", "^([^:]*)", 1)
    return area.records().select(_rel_key().alias("file_key"), "status", reason.alias("reason"),
                                 F.lit(area.rows().count()).alias("rows_loaded"))


class _Stopped(ig.Load):
    """A run that ends after its writes, before it publishes."""

    def publish(self, *args, **kwargs):
        raise InterruptedError


def ingest_crash_replay(spark, sf_dir):
    """A run that stopped between its writes and its publish, then the same run again."""
    area = Area(spark, "ingest_crash_replay")
    fixtures.order_documents(spark, sf_dir, area.src)
    area.schema = T.StructType([T.StructField("data", T.StringType())])
    try:
        _Stopped(spark, INGEST_TARGET, area.schema, ["data"], area.target, area.ledger, {}, RUN_TIMES[0]).run(area.src, "json", "meta")
    except InterruptedError:
        pass
    stopped = area.rows().count()
    area.load(1)
    return area.rows().select("data", F.lit(stopped).alias("rows_before"))


def ingest_defaults(spark, sf_dir):
    """Target columns that are not loaded: a running number and the time of the run."""
    area = Area(spark, "ingest_defaults", STAGE_TARGET)
    fixtures.order_documents(spark, sf_dir, area.src)
    area.load(defaults={"load_id": ig.SERIAL, "ingest_time": ig.NOW})
    return area.rows()


def identifiers(spark, sf_dir):
    """Which names the ingestion takes for tables and for columns."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "props"])
    dotted = F.concat_ws(".", "event_type", F.concat(F.lit("t"), F.col("event_id").cast("string")))
    names = F.array(F.col("event_type"), F.col("event_id").cast("string"), F.col("props"), dotted,
                    F.concat(dotted, F.lit(".x")), F.concat(F.lit("_"), F.col("event_id").cast("string")), F.concat(F.col("event_type"), F.lit(" ;")))
    return (ev.select("event_id", F.posexplode(names).alias("k", "name"))
            .select("event_id", "k", "name", ig.is_table_name(F.col("name")).alias("table_ok"), ig.is_column_name(F.col("name")).alias("column_ok")))


QUERIES = {f.__name__: f for f in (
    ingest_listing, ingest_formats, ingest_summary, ingest_ledger_skip, ingest_failures, ledger_current,
    ingest_csv_headers, ingest_mixed_failures, ingest_crash_replay, ingest_defaults, identifiers)}

_BROKEN = f"SELECT o_orderkey // {BROKEN_ORDERS_PER_FILE} AS g, count(*) AS n FROM orders GROUP BY 1"
ORACLE_SQL = {
    "ingest_csv_headers": f"""
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey // {ORDERS_PER_FILE} % 3 <> 2 THEN o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority || chr(10) || '"' || o_orderstatus || '", x' AS o_orderpriority
        FROM orders""",
    "ingest_mixed_failures": f"""
        WITH files AS ({_BROKEN})
        SELECT CASE g % 6 WHEN 0 THEN 'good-' || g || '.parquet' WHEN 1 THEN 'damaged-' || g || '.parquet'
                          WHEN 2 THEN 'cut-' || g || '.parquet' WHEN 3 THEN '_hidden-' || g || '.ndjson'
                          WHEN 4 THEN 'empty-' || g || '.json' ELSE 'bad-' || g || '.csv' END AS file_key,
               CASE WHEN g % 6 IN (0, 3) THEN 'SUCCESS' ELSE 'FAILED' END AS status,
               CASE WHEN g % 6 IN (1, 2) THEN 'unreadable parquet file' WHEN g % 6 = 4 THEN 'the file is empty'
                    WHEN g % 6 = 5 THEN 'invalid value for column o_custkey' END AS reason,
               (SELECT CAST(coalesce(sum(n), 0) AS INTEGER) FROM files WHERE g % 6 IN (0, 3)) AS rows_loaded
        FROM files""",
    "ingest_crash_replay": "SELECT o_orderkey || ':' || o_orderstatus AS data, CAST(0 AS INTEGER) AS rows_before FROM orders",
    "ingest_defaults": f"""
        SELECT row_number() OVER (ORDER BY 'orders-' || (o_orderkey // {ORDERS_PER_FILE}) || '.ndjson', o_orderkey) AS load_id,
               TIMESTAMP '2026-01-01 00:00:00' AS ingest_time, o_orderkey || ':' || o_orderstatus AS data
        FROM orders""",
    "identifiers": r"""
        WITH names AS (
          SELECT event_id, event_type AS a, CAST(event_id AS VARCHAR) AS b, props AS c, event_type || '.t' || event_id AS d FROM events),
        each AS (
          SELECT event_id, 0 AS k, a AS name FROM names UNION ALL SELECT event_id, 1, b FROM names UNION ALL SELECT event_id, 2, c FROM names
          UNION ALL SELECT event_id, 3, d FROM names UNION ALL SELECT event_id, 4, d || '.x' FROM names
          UNION ALL SELECT event_id, 5, '_' || b FROM names UNION ALL SELECT event_id, 6, a || ' ;' FROM names)
        SELECT event_id, k, name, regexp_matches(name, '^[a-zA-Z_][a-zA-Z0-9_]*(\.[a-zA-Z_][a-zA-Z0-9_]*)?$') AS table_ok,
               regexp_matches(name, '^[a-zA-Z_][a-zA-Z0-9_]*$') AS column_ok
        FROM each""",
}
