"""Fixed schemas (never inferred) for every table the pipeline owns."""

from pyspark.sql import types as T

# Bronze: one row per API response (or per bounded part of one).
BRONZE = T.StructType([
    T.StructField("load_id", T.LongType(), False),
    T.StructField("ingest_time", T.TimestampNTZType(), False),
    T.StructField("data", T.StringType(), True),
])

# Only what the flatten reads from the payload: a pruned parse schema.
PAYLOAD = T.StructType([
    T.StructField("time", T.LongType(), True),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType())), True),
])

# Silver flight mart. Timestamps are UTC wall-clock TIMESTAMP_NTZ.
MART = T.StructType([
    T.StructField("load_id", T.LongType(), False),
    T.StructField("uploaded_at", T.TimestampNTZType(), False),
    T.StructField("time_position", T.TimestampNTZType(), True),
    T.StructField("last_contact", T.TimestampNTZType(), True),
    T.StructField("icao24", T.StringType(), True),
    T.StructField("callsign", T.StringType(), True),
    T.StructField("origin_country", T.StringType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("baro_altitude", T.DoubleType(), True),
    T.StructField("on_ground", T.BooleanType(), True),
    T.StructField("velocity", T.DoubleType(), True),
    T.StructField("true_track", T.DoubleType(), True),
    T.StructField("vertical_rate", T.DoubleType(), True),
    T.StructField("geo_altitude", T.DoubleType(), True),
    T.StructField("squawk", T.StringType(), True),
    T.StructField("spi", T.BooleanType(), True),
    T.StructField("position_source", T.IntegerType(), True),
])
MART_COLUMNS = [f.name for f in MART.fields]

# Gold: hourly analytics per origin country.
HOURLY = T.StructType([
    T.StructField("origin_country", T.StringType(), True),
    T.StructField("fly_date", T.DateType(), True),
    T.StructField("fly_hour", T.IntegerType(), True),
    T.StructField("fly_count", T.LongType(), False),
    T.StructField("hourly_avg_velocity", T.DoubleType(), True),
    T.StructField("hourly_avg_altitude", T.DoubleType(), True),
])

# Run log, after the run_id column was added.
RUN_LOG = T.StructType([
    T.StructField("logged_at", T.TimestampNTZType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("logger", T.StringType(), True),
    T.StructField("func_name", T.StringType(), True),
    T.StructField("line_no", T.IntegerType(), True),
    T.StructField("pathname", T.StringType(), True),
    T.StructField("run_id", T.StringType(), True),
])
RUN_LOG_V1 = T.StructType(RUN_LOG.fields[:-1])

# File-ingestion ledger; unique on (target_table, file_key, etag).
LEDGER = T.StructType([
    T.StructField("target_table", T.StringType(), False),
    T.StructField("file_key", T.StringType(), False),
    T.StructField("etag", T.StringType(), False),
    T.StructField("file_size", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), False),
])


# Driver tables read by the registered queries (types as stored).
DRIVER_TABLES = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    ]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
    ]),
}
