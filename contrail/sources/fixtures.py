"""Synthetic flight snapshots derived from the driver tables.

``events`` joined with ``nation`` gives one aircraft report per event. Reports
are grouped into one snapshot per clock hour (``load_id`` = hours since the
epoch, ``uploaded_at`` = end of that hour) and rendered as the API payload
``{"time": ..., "states": [[17 values], ...]}``.

A snapshot is split into parts of at most ``states_per_part`` states, keyed by
``event_id div states_per_part``: event ids are unique, so no part can grow
past that bound however many reports fall into one hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail.functions.memo import memo
from contrail.functions.time import ntz_to_seconds, seconds_to_ntz
from contrail.sources.fs import _by_value, arrow_fs
from contrail.sources.tables import read_table

# About the size of one real world-wide API response.
STATES_PER_PART = 10_000


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def flight_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the typed fields of its state vector."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    join_on, cols, vertical = memo(("flight_reports",), _report_columns)
    # nation is the fixed 25-row dimension; Spark's size estimate broadcasts it.
    joined = events.join(nation, join_on)
    return joined.select(*cols).withColumn("vertical_rate", vertical).drop("vertical_rate_num")


def _report_columns():
    e = F.col("event_id")
    secs = ntz_to_seconds(F.col("ts"))
    airline = (F.when(F.col("user_id") % 5 == 0, "AAL").when(F.col("user_id") % 5 == 1, "DLH")
               .when(F.col("user_id") % 5 == 2, "AFR").when(F.col("user_id") % 5 == 3, "BAW")
               .otherwise("UAE"))
    join_on = F.pmod(F.col("user_id"), F.lit(25)) == F.col("n_nationkey")
    cols = [
        e.alias("event_id"),
        F.floor(secs / 3600).alias("load_id"),
        seconds_to_ntz((F.floor(secs / 3600) + 1) * 3600).alias("uploaded_at"),
        _null_when(e % 97 == 0, secs).alias("time_position_s"),
        (secs + 1).alias("last_contact_s"),
        F.format_string("%06x", F.col("user_id")).alias("icao24"),
        F.rpad(F.concat(airline, (F.col("user_id") + 100).cast("string")), 8, " ").alias("callsign"),
        F.col("n_name").alias("origin_country"),
        _null_when(e % 50 == 0, (e % 3600).cast("double") / 10 - 180).alias("longitude"),
        _null_when(e % 50 == 0, (e % 1800).cast("double") / 10 - 90).alias("latitude"),
        _null_when(e % 11 == 0, (e * 7 % 12000).cast("double")).alias("baro_altitude"),
        (e % 10 == 0).alias("on_ground"),
        F.col("value").alias("velocity"),
        (e % 360).cast("double").alias("true_track"),
        (e % 41 - 20).cast("double").alias("vertical_rate_num"),
        F.when(e % 2 == 1, F.array(F.lit(1), F.lit(2))).alias("sensors"),
        _null_when(e % 13 == 0, (e * 7 % 12000 + 50).cast("double")).alias("geo_altitude"),
        _null_when(e % 3 == 0, F.lpad((e % 7778).cast("string"), 4, "0")).alias("squawk"),
        (e % 17 == 0).alias("spi"),
        (e % 4).cast("int").alias("position_source"),
    ]
    return join_on, cols, F.col("vertical_rate_num") / 4


STATE_FIELDS = ["icao24", "callsign", "origin_country", "time_position_s", "last_contact_s",
                "longitude", "latitude", "baro_altitude", "on_ground", "velocity", "true_track",
                "vertical_rate", "sensors", "geo_altitude", "squawk", "spi", "position_source"]


def state_json(st: Column) -> Column:
    """The 17-element state vector in struct ``st``, as JSON text.

    Values keep their JSON types (text quoted, numbers and booleans bare, the
    sensor list nested, null as null): each is cast to VARIANT and the array
    is rendered by one ``to_json`` call.
    """
    return F.to_json(F.array(*[st.getField(c).cast("variant") for c in STATE_FIELDS]))


def snapshot_parts(spark: SparkSession, sf_dir: str,
                   states_per_part: int = STATES_PER_PART) -> DataFrame:
    """Bronze-shaped rows ``(load_id, part, ingest_time, data)``, one per bounded part.

    The shuffle carries typed report fields; each part renders its own JSON
    after the shuffle, so rendering runs in parallel across parts.
    """
    reports = flight_reports(spark, sf_dir)
    row_cols, agg_col, out_cols = memo(("snapshot_parts", states_per_part),
                                       lambda: _parts_columns(states_per_part))
    return reports.select(*row_cols).groupBy("load_id", "part", "uploaded_at").agg(agg_col).select(*out_cols)


def _parts_columns(states_per_part: int):
    row_cols = [F.col("load_id"), F.col("uploaded_at"),
                F.floor(F.col("event_id") / states_per_part).alias("part"),
                F.struct("event_id", *STATE_FIELDS).alias("st")]
    # Sorting is within one part only (bounded), for a stable payload text.
    agg_col = F.array_sort(F.collect_list("st")).alias("sts")
    payload = F.concat(
        F.lit('{"time":'), ntz_to_seconds(F.col("uploaded_at")).cast("string"),
        F.lit(',"states":['), F.concat_ws(",", F.transform("sts", state_json)), F.lit("]}"))
    out_cols = [F.col("load_id"), F.col("part"), F.col("uploaded_at").alias("ingest_time"),
                payload.alias("data")]
    return row_cols, agg_col, out_cols


def snapshot_bronze(spark: SparkSession, sf_dir: str,
                    states_per_part: int = STATES_PER_PART) -> DataFrame:
    """Bronze table ``(load_id, ingest_time, data)`` as ingestion would leave it."""
    return snapshot_parts(spark, sf_dir, states_per_part).drop("part")


def run_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records derived from ``events`` (``run_id`` '' marks the old layout)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    e = F.col("event_id")
    level = (F.when(F.col("event_type") == "error",
                    F.when(e % 7 == 0, "CRITICAL").otherwise("ERROR"))
             .when(F.col("event_type") == "signup", "WARNING").otherwise("INFO"))
    return ev.select(
        seconds_to_ntz(ntz_to_seconds(F.col("ts"))).alias("logged_at"),
        level.alias("level"),
        F.concat(F.lit("flights loaded: "), e.cast("string"), F.lit(" "), F.col("props")).alias("message"),
        F.lit("root").alias("logger"),
        F.col("event_type").alias("func_name"),
        (e % 300).cast("int").alias("line_no"),
        F.lit("etl/job.py").alias("pathname"),
        F.when(e < 5000, F.lit("")).otherwise(F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("run_id"),
    )


# Orders per ingest fixture file (files never grow past it).
ORDERS_PER_FILE = 5_000
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def write_named_files(files: DataFrame) -> None:
    """Write each ``(path, content)`` row as one file, from the executors.

    Names are deterministic, so a retried task rewrites the same files.
    """
    to_fs = _by_value(arrow_fs)

    def _write(rows):  # runs in Python workers: references nothing of this package
        for r in rows:
            filesystem, p = to_fs(r["path"])
            filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
            with filesystem.open_output_stream(p) as out:
                out.write(r["content"].encode("utf-8"))
    files.foreachPartition(_write)


def ingest_source_files(spark: SparkSession, sf_dir: str, root: str, rewrite: bool = False) -> None:
    """``orders`` split into files of four formats (plus traps) under ``root``.

    split = o_orderkey % 4, file group g = o_orderkey div ORDERS_PER_FILE:
    0 -> json/orders-g.json (top-level list; .JSON for odd g) and other/orders-g.txt (ignored)
    1 -> ndjson/orders-g.ndjson (with a blank line)
    2 -> csv/orders-g.csv (header) and csv/bad/orders-g-bad.csv (o_custkey not a number)
    3 -> parquet/g=g/part-*.parquet (Spark's writer, one file per group)
    With ``rewrite`` only the ndjson files are written again with new content.
    """
    orders = read_table(spark, sf_dir, "orders", ORDER_COLUMNS)
    keyed = orders.withColumns({"split": F.col("o_orderkey") % 4,
                                "g": F.floor(F.col("o_orderkey") / ORDERS_PER_FILE)})
    obj = F.to_json(F.struct(*ORDER_COLUMNS))
    line_csv = F.to_csv(F.struct(*ORDER_COLUMNS))
    bad_csv = F.to_csv(F.struct(*[F.concat(F.col(c).cast("string"), F.lit("x")).alias(c) if c == "o_custkey"
                                  else F.col(c) for c in ORDER_COLUMNS]))
    header = ",".join(ORDER_COLUMNS)

    def lines(expr):  # sorted within one bounded file group
        return F.transform(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey"), expr.alias("v")))),
                           lambda x: x.getField("v"))

    g = F.col("g").cast("string")
    base = F.lit(root.rstrip("/") + "/")
    specs = []
    if not rewrite:
        specs += [
            (0, F.concat(base, F.lit("json/orders-"), g, F.when(F.col("g") % 2 == 1, ".JSON").otherwise(".json")),
             lambda: F.concat(F.lit("["), F.concat_ws(",", lines(obj)), F.lit("]"))),
            (0, F.concat(base, F.lit("other/orders-"), g, F.lit(".txt")),
             lambda: F.concat_ws("\n", lines(obj))),
            (1, F.concat(base, F.lit("ndjson/orders-"), g, F.lit(".ndjson")),
             lambda: F.concat(F.lit("\n"), F.concat_ws("\n", lines(obj)), F.lit("\n"))),
            (2, F.concat(base, F.lit("csv/orders-"), g, F.lit(".csv")),
             lambda: F.concat(F.lit(header + "\n"), F.concat_ws("\n", lines(line_csv)), F.lit("\n"))),
            (2, F.concat(base, F.lit("csv/bad/orders-"), g, F.lit("-bad.csv")),
             lambda: F.concat(F.lit(header + "\n"), F.concat_ws("\n", lines(bad_csv)), F.lit("\n"))),
        ]
    else:
        specs += [
            (1, F.concat(base, F.lit("ndjson/orders-"), g, F.lit(".ndjson")),
             lambda: F.concat(F.concat_ws("\n", F.reverse(lines(obj))), F.lit("\n\n\n"))),
        ]
    frames = [keyed.where(F.col("split") == split).groupBy("g")
              .agg(content().alias("content")).select(path.alias("path"), "content")
              for split, path, content in specs]
    files = frames[0]
    for fr in frames[1:]:
        files = files.unionByName(fr)
    write_named_files(files)
    if not rewrite:
        pq = keyed.where(F.col("split") == 3)
        (pq.repartition("g").select(*ORDER_COLUMNS, "g").write.mode("overwrite")
         .partitionBy("g").parquet(f"{root.rstrip('/')}/parquet"))


def csv_header_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``orders`` as CSV files of three headers, by file group g = o_orderkey div ORDERS_PER_FILE.

    g % 3 = 0: the columns in order; 1: reversed, with one more; 2: without
    o_orderstatus. The priority holds a newline, quotes and a comma.
    """
    orders = read_table(spark, sf_dir, "orders", ORDER_COLUMNS)
    note = F.concat(F.col("o_orderpriority"), F.lit('\n"'), F.col("o_orderstatus"), F.lit('", x'))
    quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
    text = {c: quoted if c == "o_orderpriority" else F.col(c).cast("string") for c in ORDER_COLUMNS}
    headers = [ORDER_COLUMNS, [*reversed(ORDER_COLUMNS), "junk"], [c for c in ORDER_COLUMNS if c != "o_orderstatus"]]
    line = lambda names: F.concat_ws(",", *[text.get(c, F.lit("j")) for c in names])
    g = F.floor(F.col("o_orderkey") / ORDERS_PER_FILE)
    pick = lambda values: F.when(F.col("g") % 3 == 0, values[0]).when(F.col("g") % 3 == 1, values[1]).otherwise(values[2])
    rows = orders.withColumn("g", g).select("g", "o_orderkey", pick([line(h) for h in headers]).alias("line"))
    files = rows.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "line"))).alias("rows"))  # bounded groups
    content = F.concat(pick([F.lit(",".join(h)) for h in headers]), F.lit("\n"),
                       F.concat_ws("\n", F.transform("rows", lambda r: r["line"])), F.lit("\n"))
    write_named_files(files.select(F.concat(F.lit(root.rstrip("/") + "/orders-"), F.col("g").cast("string"), F.lit(".csv")).alias("path"),
                                   content.alias("content")))


BROKEN_ORDERS_PER_FILE = 1_000


def broken_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``orders`` in small files, most of which cannot be loaded, by g = o_orderkey div BROKEN_ORDERS_PER_FILE.

    g % 6: 0 good.parquet; 1 Parquet with destroyed pages behind a whole footer;
    2 truncated Parquet; 3 good ndjson under a hidden name; 4 an empty json; 5 a
    csv whose o_custkey is no number.
    """
    orders = read_table(spark, sf_dir, "orders", ORDER_COLUMNS)
    to_fs, columns, top = _by_value(arrow_fs), list(ORDER_COLUMNS), root.rstrip("/")

    def write(pdf):  # runs in Python workers: references nothing of this package
        import io

        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq

        g = int(pdf["g"].iloc[0])
        pdf = pdf[columns].sort_values("o_orderkey")
        sink = io.BytesIO()
        pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), sink, coerce_timestamps="us")
        data = bytearray(sink.getvalue())
        kind = g % 6
        if kind == 1:
            column = pq.ParquetFile(io.BytesIO(bytes(data))).metadata.row_group(0).column(0)
            start = column.dictionary_page_offset or column.data_page_offset
            data[start:start + column.total_compressed_size] = b"\xff" * column.total_compressed_size
        elif kind == 2:
            data = data[:len(data) // 2]
        elif kind == 3:
            data = pdf.to_json(orient="records", lines=True, date_format="iso").encode()
        elif kind == 4:
            data = b""
        elif kind == 5:
            data = pdf.assign(o_custkey=pdf["o_custkey"].astype(str) + "x").to_csv(index=False).encode()
        name = [f"good-{g}.parquet", f"damaged-{g}.parquet", f"cut-{g}.parquet", f"_hidden-{g}.ndjson", f"empty-{g}.json", f"bad-{g}.csv"][kind]
        filesystem, path = to_fs(f"{top}/{name}")
        filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(path) as out:
            out.write(bytes(data))
        return pd.DataFrame({"g": [g]})

    keyed = orders.withColumn("g", F.floor(F.col("o_orderkey") / BROKEN_ORDERS_PER_FILE))
    keyed.groupBy("g").applyInPandas(write, "g long").count()


def order_documents(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``orders`` as ndjson files of one text field, {"data": "<key>:<status>"}, by g = o_orderkey div ORDERS_PER_FILE."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    line = F.to_json(F.struct(F.concat(F.col("o_orderkey").cast("string"), F.lit(":"), F.col("o_orderstatus")).alias("data")))
    rows = orders.select(F.floor(F.col("o_orderkey") / ORDERS_PER_FILE).alias("g"), "o_orderkey", line.alias("line"))
    files = rows.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "line"))).alias("rows"))  # bounded groups
    write_named_files(files.select(
        F.concat(F.lit(root.rstrip("/") + "/orders-"), F.col("g").cast("string"), F.lit(".ndjson")).alias("path"),
        F.concat(F.concat_ws("\n", F.transform("rows", lambda r: r["line"])), F.lit("\n")).alias("content")))
