"""DuckDB twins of the catalogue queries, over the same driver tables.

The oracle builds the flight rows ``F`` straight from ``events`` and
``nation`` (no JSON); the Spark side must reach the same rows through the
snapshot payloads. Means come from an exact decimal sum and are rounded with
``round_even(x*100, 0)/100``, the same half-even rounding as Spark's ``rint``.
"""

from __future__ import annotations

from contrail.plans import ingestion, params as P
from contrail.sources.fixtures import ORDERS_PER_FILE


def avg(c: str) -> str:
    """Order-independent mean. The measures here have at most 6 fractional digits, so the
    decimal sum is their exact sum; the operator's double sum for other values stays empty."""
    dec = f"CAST({c} AS DECIMAL(38,6))"
    return f"(CAST(sum({dec}) AS DOUBLE) / count({dec}))"


# Written out here, apart from the code under test.
NUMBER_RE = r"^ *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
INTEGER_RE = r"^ *[+-]?[0-9]+ *$"
AIRLINE_RE = r"^([A-Z]{3})[0-9]"
CDC_MARKERS = ("_peerdb_is_deleted", "_peerdb_version")

_AS_OF = P.AS_OF.strftime("%Y-%m-%d %H:%M:%S")
_DAY = P.DAY.isoformat()

# Reports with their event id (R) and the mart rows (F).
BASE = f"""
WITH e AS (SELECT *, date_trunc('second', ts) AS t FROM events),
R AS (
  SELECT event_id,
         CAST(floor(epoch(t) / 3600) AS BIGINT)                    AS load_id,
         date_trunc('hour', t) + INTERVAL 1 HOUR                   AS uploaded_at,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE t END          AS time_position,
         t + INTERVAL 1 SECOND                                     AS last_contact,
         printf('%06x', user_id)                                   AS icao24,
         rpad(CASE user_id % 5 WHEN 0 THEN 'AAL' WHEN 1 THEN 'DLH' WHEN 2 THEN 'AFR'
              WHEN 3 THEN 'BAW' ELSE 'UAE' END || CAST(100 + user_id AS VARCHAR), 8, ' ') AS callsign,
         n_name                                                    AS origin_country,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE CAST(event_id % 3600 AS DOUBLE) / 10 - 180 END  AS longitude,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE CAST(event_id % 1800 AS DOUBLE) / 10 - 90 END   AS latitude,
         CASE WHEN event_id % 11 = 0 THEN NULL
              ELSE CAST(event_id * 7 % 12000 AS DOUBLE) END        AS baro_altitude,
         event_id % 10 = 0                                         AS on_ground,
         value                                                     AS velocity,
         CAST(event_id % 360 AS DOUBLE)                            AS true_track,
         CAST(event_id % 41 - 20 AS DOUBLE) / 4                    AS vertical_rate,
         CASE WHEN event_id % 13 = 0 THEN NULL
              ELSE CAST(event_id * 7 % 12000 + 50 AS DOUBLE) END   AS geo_altitude,
         CASE WHEN event_id % 3 = 0 THEN NULL
              ELSE lpad(CAST(event_id % 7778 AS VARCHAR), 4, '0') END AS squawk,
         event_id % 17 = 0                                         AS spi,
         CAST(event_id % 4 AS INTEGER)                             AS position_source
  FROM e JOIN nation ON n_nationkey = user_id % 25
),
F AS (
  SELECT load_id, uploaded_at, time_position, last_contact, icao24, callsign,
         origin_country, longitude, latitude, baro_altitude, on_ground, velocity,
         true_track, vertical_rate, geo_altitude, squawk, spi, position_source
  FROM R
),
H AS (
  SELECT origin_country,
         CAST(time_position AS DATE)            AS fly_date,
         CAST(hour(time_position) AS INTEGER)   AS fly_hour,
         COUNT(DISTINCT icao24)                 AS fly_count,
         round_even({avg('velocity')} * 100, 0) / 100      AS hourly_avg_velocity,
         round_even({avg('baro_altitude')} * 100, 0) / 100 AS hourly_avg_altitude
  FROM F
  WHERE on_ground = false AND time_position IS NOT NULL
  GROUP BY 1, 2, 3
),
DAYROWS AS (
  SELECT fly_date, CAST(round(fly_hour, 0) AS INTEGER) AS fly_hour, fly_count AS flights,
         round(hourly_avg_altitude, 2) AS avg_altitude,
         round(hourly_avg_velocity, 2) AS avg_velocity
  FROM H
  WHERE origin_country = '{P.COUNTRY}' AND fly_date = DATE '{_DAY}'
),
LATEST AS (
  SELECT * FROM F WHERE uploaded_at = (SELECT max(uploaded_at) FROM F)
)
"""


LOG = """
WITH LOG AS (
  SELECT date_trunc('second', ts) AS logged_at,
         CASE event_type WHEN 'error' THEN CASE WHEN event_id % 7 = 0 THEN 'CRITICAL' ELSE 'ERROR' END
                         WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
         concat('flights loaded: ', CAST(event_id AS VARCHAR), ' ', props) AS message,
         'root' AS logger, event_type AS func_name, CAST(event_id % 300 AS INT) AS line_no,
         'etl/job.py' AS pathname,
         CASE WHEN event_id < 5000 THEN '' ELSE lpad(CAST(user_id AS VARCHAR), 4, '0') END AS run_id
  FROM events
)
"""


_OPF = ORDERS_PER_FILE
FILES = f"""
WITH O AS (SELECT o_orderkey % 4 AS split, o_orderkey // {_OPF} AS g FROM orders GROUP BY 1, 2),
K AS (
  SELECT 'json' AS ext, 'json/orders-' || CAST(g AS VARCHAR) || CASE WHEN g % 2 = 1 THEN '.JSON' ELSE '.json' END AS file_key,
         'SUCCESS' AS status, 1 AS n FROM O WHERE split = 0
  UNION ALL SELECT 'ndjson', 'ndjson/orders-' || CAST(g AS VARCHAR) || '.ndjson', 'SUCCESS', 2 FROM O WHERE split = 1
  UNION ALL SELECT 'csv', 'csv/orders-' || CAST(g AS VARCHAR) || '.csv', 'SUCCESS', 1 FROM O WHERE split = 2
  UNION ALL SELECT 'csv', 'csv/bad/orders-' || CAST(g AS VARCHAR) || '-bad.csv', 'FAILED', 1 FROM O WHERE split = 2
  UNION ALL SELECT 'parquet', 'parquet/g=' || CAST(g AS VARCHAR) || '/part.parquet', 'SUCCESS', 1 FROM O WHERE split = 3
),
C AS (SELECT sum(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS good,
             sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS bad,
             sum(CASE WHEN ext = 'ndjson' THEN 1 ELSE 0 END) AS nd FROM K),
N AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 4 = 1) AS nd_rows FROM orders)
"""


def _q(body: str) -> str:
    return BASE + body


def _f64(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMBER_RE}') THEN try_cast(trim({x}) AS DOUBLE) END"


def _i32(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{INTEGER_RE}') THEN try_cast(trim({x}) AS INTEGER) END"


def _uz(x: str, hi: int) -> str:
    v = f"try_cast(trim({x}) AS BIGINT)"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce(CASE WHEN regexp_matches({x}, '{INTEGER_RE}') "
            f"AND {v} BETWEEN 0 AND {hi} THEN {v} END, 0) END")


_TOKENS = [
    "CAST(event_id AS VARCHAR)",
    "CAST(user_id AS VARCHAR) || '.' || CAST(event_id % 100 AS VARCHAR)",
    "event_type",
    "' ' || CAST(event_id % 300 AS VARCHAR) || ' '",
    "'-' || CAST(event_id AS VARCHAR)",
    "CAST(event_id % 1000 AS VARCHAR) || 'e2'",
    "CAST(event_id AS VARCHAR) || 'd'",
    "CAST(event_id + 4294967290 AS VARCHAR)",
    "CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '' END",
    "CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 512 AS VARCHAR) END",
    "props",
    "'.' || CAST(event_id % 10 AS VARCHAR)",
]
_TOKENS_SQL = "\nUNION ALL\n".join(
    f"SELECT event_id, {i + 1} AS token_no, {t} AS token FROM events" for i, t in enumerate(_TOKENS))

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update({
    "flatten_states": _q("SELECT * FROM F"),
    "flatten_strict": _q("SELECT * FROM F"),
    "flatten_cdc": _q(f"""SELECT *, CAST(0 AS SMALLINT) AS {CDC_MARKERS[0]},
                                 CAST(0 AS BIGINT) AS {CDC_MARKERS[1]} FROM F"""),
    "snapshot_counts": _q("""SELECT load_id, uploaded_at, count(*) AS n_states
                             FROM F GROUP BY load_id, uploaded_at"""),
    "json_access": _q(f"""
        SELECT load_id, CAST(epoch(uploaded_at) AS BIGINT) AS snapshot_time,
               arg_min(icao24, event_id) AS first_icao24,
               arg_min(callsign, event_id) AS first_callsign,
               count(*) AS n_states
        FROM R GROUP BY load_id, event_id // {P.STATES_PER_PART}, uploaded_at"""),
    "cast_lenient": f"""
        SELECT event_id, token_no, token,
               {_f64('token')} AS f64,
               {_i32('token')} AS i32,
               {_uz('token', 4294967295)} AS u32z,
               {_uz('token', 255)} AS u8z,
               try_cast(trim(token) AS BOOLEAN) AS bool_cast,
               ({_uz('token', 255)}) <> 0 AS bool_u8
        FROM ({_TOKENS_SQL}) tokens""",
    "latest_watermark": _q("SELECT * FROM LATEST"),
    "latest_rank": _q("""SELECT * EXCLUDE (indx) FROM (
                           SELECT *, rank() OVER (ORDER BY load_id DESC) AS indx FROM F)
                         WHERE indx = 1"""),
    "snapshot_asof": _q(f"""SELECT * FROM F WHERE uploaded_at = (
                              SELECT max(uploaded_at) FROM F
                              WHERE uploaded_at <= TIMESTAMP '{_AS_OF}')"""),
    "hourly_prev": _q(f"""
        SELECT origin_country, CAST(time_position AS DATE) AS fly_date,
               CAST(hour(time_position) AS INTEGER) AS fly_hour,
               COUNT(DISTINCT icao24) AS fly_count,
               round_even({avg('velocity')} * 100, 0) / 100 AS hourly_avg_velocity,
               round_even({avg('baro_altitude')} * 100, 0) / 100 AS hourly_avg_altitude
        FROM F
        WHERE time_position >= date_trunc('hour', TIMESTAMP '{_AS_OF}') - INTERVAL 1 HOUR
          AND time_position < date_trunc('hour', TIMESTAMP '{_AS_OF}')
          AND on_ground = false
        GROUP BY 1, 2, 3
        ORDER BY fly_hour, origin_country"""),
    "hourly_all": _q("SELECT * FROM H"),
    "airline_hourly": _q(f"""
        SELECT regexp_extract(callsign, '{AIRLINE_RE}', 1) AS airline,
               CAST(time_position AS DATE) AS fly_date,
               CAST(hour(time_position) AS INTEGER) AS fly_hour,
               COUNT(DISTINCT icao24) AS fly_count,
               round_even({avg('velocity')} * 100, 0) / 100 AS hourly_avg_velocity,
               round_even({avg('baro_altitude')} * 100, 0) / 100 AS hourly_avg_altitude
        FROM F
        WHERE on_ground = false AND time_position IS NOT NULL
          AND regexp_extract(callsign, '{AIRLINE_RE}', 1) <> ''
        GROUP BY 1, 2, 3"""),
    "country_day": _q("SELECT * FROM DAYROWS ORDER BY fly_hour"),
    "country_day_total": _q(f"""
        SELECT CAST(fly_date AS VARCHAR) AS fly_date, CAST(fly_hour AS VARCHAR) AS fly_hour,
               flights, avg_altitude, avg_velocity FROM DAYROWS
        UNION ALL
        SELECT 'Total', '', CAST(sum(flights) AS BIGINT),
               round_even({avg('avg_altitude')} * 100, 0) / 100,
               round_even({avg('avg_velocity')} * 100, 0) / 100
        FROM DAYROWS HAVING count(*) > 0"""),
    "countries": _q("""SELECT DISTINCT origin_country FROM LATEST
                       WHERE latitude IS NOT NULL AND longitude IS NOT NULL
                         AND origin_country IS NOT NULL ORDER BY 1"""),
    "bronze_snapshots": _q(f"""
        SELECT CAST(row_number() OVER (ORDER BY load_id, part) AS BIGINT) AS load_id,
               uploaded_at, n_states
        FROM (SELECT load_id, event_id // {P.STATES_PER_PART} AS part, uploaded_at,
                     count(*) AS n_states
              FROM R GROUP BY 1, 2, 3)"""),
    "sink_latest_roundtrip": _q("SELECT * FROM LATEST"),
    "sink_hourly_roundtrip": _q("SELECT * FROM H"),
    "backfill_no_dups": _q("SELECT * FROM F"),
    "run_log_recent": LOG + "SELECT * FROM LOG ORDER BY logged_at DESC",
    "alerts": LOG + """SELECT *, concat('[', level, '] Flight pipeline: ', substring(message, 1, 80)) AS subject
                       FROM LOG WHERE level IN ('ERROR', 'CRITICAL')""",
    "ingest_listing": FILES + """
        SELECT p.file_type, K.ext, count(*) AS n_files
        FROM K JOIN (VALUES ('all', 'json'), ('all', 'ndjson'), ('all', 'csv'), ('all', 'parquet'),
                            ('json', 'json'), ('json', 'ndjson'), (' .CSV', 'csv'),
                            ('parquet', 'parquet')) p(file_type, ext) ON p.ext = K.ext
        GROUP BY 1, 2""",
    "ingest_formats": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                                o_orderpriority FROM orders""",
    "ingest_summary": FILES + """
        SELECT 1 AS run, CAST(good AS INTEGER) AS files_processed, 0 AS files_skipped,
               CAST(bad AS INTEGER) AS files_failed, n_rows AS rows_added FROM C, N
        UNION ALL SELECT 2, 0, CAST(good AS INTEGER), CAST(bad AS INTEGER), 0 FROM C
        UNION ALL SELECT 3, CAST(nd AS INTEGER), CAST(good - nd AS INTEGER), CAST(bad AS INTEGER), nd_rows
        FROM C, N""",
    "ingest_ledger_skip": FILES + "SELECT file_key FROM K WHERE status = 'SUCCESS'",
    "ingest_failures": FILES + """SELECT file_key, 'invalid value for column o_custkey' AS error_message,
                                         CAST(3 AS BIGINT) AS n_attempts FROM K WHERE status = 'FAILED'""",
    "ledger_current": FILES + "SELECT file_key, status, CAST(n AS BIGINT) AS n_etags FROM K",
    "stream_flatten": _q("SELECT * FROM F"),
    "stream_hourly": _q("SELECT * FROM H"),
    "stream_latest": _q("SELECT * FROM LATEST"),
    "live_points": _q("""SELECT * FROM LATEST
                         WHERE latitude IS NOT NULL AND longitude IS NOT NULL
                           AND origin_country IS NOT NULL"""),
})
ORACLE_SQL.update({
    "stream_late_hours": _q("SELECT * FROM H"),
    "mart_compacted": _q("SELECT * FROM F"),
    "mart_mixed_writers": _q("SELECT * FROM F"),
    "hourly_extremes": _q("""
        SELECT origin_country, CAST(time_position AS DATE) AS fly_date, CAST(hour(time_position) AS INTEGER) AS fly_hour,
               COUNT(DISTINCT icao24) AS fly_count,
               round_even(sum(second(last_contact) * power(2.0::DOUBLE, 80)) / count(*) * 100, 0) / 100 AS hourly_avg_velocity,
               round_even(sum(second(last_contact) + minute(last_contact) * power(2.0::DOUBLE, -40)) / count(*) * 100, 0) / 100 AS hourly_avg_altitude
        FROM F WHERE on_ground = false AND time_position IS NOT NULL GROUP BY 1, 2, 3"""),
    "json_first_raw": _q(f"""
        , T AS (SELECT *, '["' || icao24 || '","' || callsign || '","' || origin_country || '",'
            || coalesce(CAST(CAST(epoch(time_position) AS BIGINT) AS VARCHAR), 'null') || ',' || CAST(epoch(last_contact) AS BIGINT) || ','
            || coalesce(CAST(longitude AS VARCHAR), 'null') || ',' || coalesce(CAST(latitude AS VARCHAR), 'null') || ','
            || coalesce(CAST(baro_altitude AS VARCHAR), 'null') || ',' || on_ground || ',' || velocity || ',' || true_track || ','
            || vertical_rate || ',' || CASE WHEN event_id % 2 = 1 THEN '[1,2]' ELSE 'null' END || ','
            || coalesce(CAST(geo_altitude AS VARCHAR), 'null') || ',' || coalesce('"' || squawk || '"', 'null') || ','
            || spi || ',' || position_source || ']' AS raw FROM R)
        SELECT load_id, arg_min(raw, event_id) AS first_raw
        FROM T GROUP BY load_id, event_id // {P.STATES_PER_PART}, uploaded_at"""),
    "sql_text": _q(f"""
        SELECT icao24, count(*) AS reports, (SELECT count(*) FROM F WHERE origin_country = '{P.COUNTRY}') AS n_rows
        FROM F WHERE origin_country = '{P.COUNTRY}' GROUP BY icao24"""),
    "served_views": _q(f"""
        SELECT v.name AS "view", origin_country, count(*) AS n FROM LATEST, (VALUES ('latest'), ('ranked')) v(name) GROUP BY 1, 2
        UNION ALL SELECT 'day', '{P.COUNTRY}', CAST(sum(flights) AS BIGINT) FROM DAYROWS HAVING count(*) > 0"""),
    "day_labels": _q("""
        SELECT fly_date AS "Date", fly_hour AS "Hour", flights AS "Daily Flights", avg_altitude AS "Daily Avg Altitude (m)",
               avg_velocity AS "Daily Avg Velocity (m/s)" FROM DAYROWS"""),
    "log_sample": LOG + "SELECT max(logged_at) AS logged_at FROM LOG",
    "stream_crash_log": LOG + """
        SELECT 'CRITICAL' AS level, 'records above ERROR: ' || count(*) FILTER (WHERE level = 'CRITICAL') AS message FROM LOG""",
})
ORACLE_SQL["stream_bronze"] = ORACLE_SQL["bronze_snapshots"]
ORACLE_SQL.update(ingestion.ORACLE_SQL)
