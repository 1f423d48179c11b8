"""Landing files -> bronze, file ingestion with ledger, run log."""

import datetime as dt
import logging
import os
import time

import pytest
from pyspark.sql import functions as F

from contrail.operators import runlog
from contrail.sources import bronze as br
from contrail.sources import fixtures
from contrail.sources import ingest as ig
from tests.conftest import SF_SMALL


def test_landing_load_numbers_by_mtime_then_path_and_skips_loaded(spark, tmp_dir):
    land, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    os.makedirs(land)
    for i, name in enumerate(["b.json", "a.json", "c.json"]):
        with open(f"{land}/{name}", "w") as f:
            f.write('{"time": %d, "states": [["x%d"]]}' % (1700000000 + i, i))
        os.utime(f"{land}/{name}", (1700000000 + i, 1700000000 + i))
    assert br.load_landing(spark, land, bronze) == 3
    got = {r["source_file"].rsplit("/", 1)[1]: r["load_id"] for r in br.read_bronze(spark, bronze).collect()}
    assert got == {"b.json": 1, "a.json": 2, "c.json": 3}
    assert br.load_landing(spark, land, bronze) == 0  # nothing new
    with open(f"{land}/d.json", "w") as f:
        f.write('{"states": null}')
    assert br.load_landing(spark, land, bronze) == 1
    d = br.read_bronze(spark, bronze).where(F.col("source_file").endswith("d.json")).first()
    assert d["load_id"] == 4 and d["ingest_time"] is not None  # file time when payload has none
    sizes = dict(br.snapshot_sizes(br.read_bronze(spark, bronze)).select("load_id", "n_states").collect())
    assert sizes == {1: 1, 2: 1, 3: 1, 4: 0}


def test_ingest_validation():
    assert ig.validate("schema.table", " a, b ,") == ["a", "b"]
    for bad_table in ("1abc", "a.b.c", "x;drop"):
        with pytest.raises(ValueError):
            ig.validate(bad_table, "a")
    with pytest.raises(ValueError):
        ig.validate("t", " , ")
    with pytest.raises(ValueError):
        ig.validate("t", "a,b-c")
    assert ig.normalize_type(" .CSV ") == "csv"


def test_ingest_runs(spark, tmp_dir):
    from contrail.plans.ingestion import ORDERS_TARGET
    src, target, ledger = f"{tmp_dir}/src", f"{tmp_dir}/target", f"{tmp_dir}/ledger"
    fixtures.ingest_source_files(spark, SF_SMALL, src)
    cols = ",".join(ORDERS_TARGET.names)
    run = lambda: ig.ingest_files(spark, "stage.orders", ORDERS_TARGET, cols, src, target, ledger).first()
    p1, s1, f1 = run()
    n_orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert (s1, f1) == (0, 1) and p1 == 4  # 1 group per split at sf0.001
    assert ig.read_target(spark, target, ledger, ORDERS_TARGET).count() == n_orders
    p2, s2, f2 = run()
    assert (p2, s2, f2) == (0, 4, 1)
    assert ig.read_target(spark, target, ledger, ORDERS_TARGET).count() == n_orders  # nothing appended twice
    time.sleep(1.1)
    fixtures.ingest_source_files(spark, SF_SMALL, src, rewrite=True)
    p3, s3, f3 = run()
    assert (p3, s3, f3) == (1, 3, 1)
    cur = ig.current_ledger(ig.read_ledger(spark, ledger))
    assert cur.where("status = 'FAILED'").count() == 1
    failed = ig.read_ledger(spark, ledger).where("status = 'FAILED'").first()
    assert failed["error_message"] == "invalid value for column o_custkey"
    # file_type narrowing: json takes ndjson too, csv only csv
    exts = lambda t: sorted({r[0] for r in ig.list_files(spark, src, t).select("ext").collect()})
    assert exts("json") == ["json", "ndjson"] and exts(".CSV") == ["csv"]
    assert exts("txt") == []


def test_run_log_handler_and_alerts(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    old = spark.createDataFrame([(dt.datetime(2024, 1, 1), "ERROR", "old " + "x" * 100, "root", "f", 1, "p")],
                                "logged_at timestamp_ntz, level string, message string, logger string, "
                                "func_name string, line_no int, pathname string")
    runlog.append_log(old, path)  # written before run_id existed
    handler = runlog.SparkLogHandler("run-1")
    log = logging.getLogger("contrail-test")
    log.addHandler(handler)
    log.setLevel(logging.INFO)
    log.info("hello")
    log.critical("boom")
    log.removeHandler(handler)
    assert handler.flush_to(spark, path) == 2
    rows = runlog.read_log(spark, path)
    assert sorted(r["run_id"] for r in rows.collect()) == ["", "run-1", "run-1"]
    subjects = sorted(r["subject"] for r in runlog.alerts(rows).collect())
    assert subjects == ["[CRITICAL] Flight pipeline: boom", "[ERROR] Flight pipeline: old " + "x" * 76]
    top = runlog.recent(rows, 1).first()
    assert top["level"] in ("INFO", "CRITICAL") and top["logged_at"] > dt.datetime(2024, 1, 1)


def test_ingest_per_file_atomicity_and_md5_etag(spark, tmp_dir):
    from pyspark.sql import types as T
    src = f"{tmp_dir}/src"
    os.makedirs(f"{src}/sub")
    files = {
        "good.json": '[{"id": 1, "name": "a"}, {"id": 2, "name": "b", "extra": true}]',
        "one.json": '{"id": 3}',                                   # object -> one row, name absent -> NULL
        "bad_value.json": '[{"id": 4, "name": "c"}, {"id": "x", "name": "d"}]',
        "bad_line.ndjson": '{"id": 5, "name": "e"}\n{oops\n',
        "sub/good.ndjson": '{"id": 6, "name": "f"}\n\n{"id": 7, "name": "g"}\n',
        "skip.txt": "ignored",
    }
    for name, text in files.items():
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    run = lambda: ig.ingest_files(spark, "t", schema, "id,name", src, f"{tmp_dir}/t", f"{tmp_dir}/l",
                                  etag_mode="md5").first()
    assert tuple(run()) == (3, 0, 2)
    got = sorted(tuple(r) for r in ig.read_target(spark, f"{tmp_dir}/t", f"{tmp_dir}/l", schema).collect())
    assert got == [(1, "a"), (2, "b"), (3, None), (6, "f"), (7, "g")]
    status = {r["file_key"].rsplit("/", 1)[1]: (r["status"], r["error_message"])
              for r in ig.read_ledger(spark, f"{tmp_dir}/l").collect()}
    assert status["bad_value.json"] == ("FAILED", "invalid value for column id")
    assert status["bad_line.ndjson"] == ("FAILED", "unparsable record")
    assert status["good.json"] == ("SUCCESS", None)
    etags = {r["etag"] for r in ig.read_ledger(spark, f"{tmp_dir}/l").collect()}
    assert all(len(e) == 32 for e in etags)  # md5 hex of the content
    assert tuple(run()) == (0, 3, 2)  # good files skipped, bad ones retried


def test_file_names_needing_url_encoding(spark, tmp_dir):
    """Readers report URL-encoded paths; matching must not lose or mislabel files."""
    from pyspark.sql import types as T
    src = f"{tmp_dir}/src"
    os.makedirs(f"{src}/sub dir")
    for name, text in {"a b.json": '[{"id": 1}]', "bad %20x.json": '[{"id": "zz"}]',
                       "sub dir/c#1.ndjson": '{"id": 3}\n', "ü+.json": '{"id": 4}'}.items():
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("id", T.LongType())])
    run = lambda: tuple(ig.ingest_files(spark, "t", schema, "id", src, f"{tmp_dir}/t", f"{tmp_dir}/l").first())
    assert run() == (3, 0, 1)
    assert sorted(r[0] for r in ig.read_target(spark, f"{tmp_dir}/t", f"{tmp_dir}/l", schema).collect()) == [1, 3, 4]
    failed = [r.file_key for r in ig.read_ledger(spark, f"{tmp_dir}/l").where("status = 'FAILED'").collect()]
    assert len(failed) == 1 and failed[0].endswith("bad %20x.json")
    assert run() == (0, 3, 1)  # the bad file is retried, not skipped

    land, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    os.makedirs(f"{land}/day 1")
    for i, name in enumerate(["snap 1.json", "day 1/snap#2.json", "snap%3.json"]):
        with open(f"{land}/{name}", "w") as f:
            f.write('{"time": %d, "states": [["x"]]}' % (1700000000 + i))
    assert br.load_landing(spark, land, bronze, order_by="path") == 3
    assert br.read_bronze(spark, bronze).count() == 3
    assert br.load_landing(spark, land, bronze) == 0


def test_unreadable_parquet_fails_alone(spark, tmp_dir):
    from pyspark.sql import types as T
    src = f"{tmp_dir}/src"
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").coalesce(1).write.parquet(f"{src}/good")
    os.makedirs(f"{src}/bad")
    with open(f"{src}/bad/broken.parquet", "wb") as f:
        f.write(b"PAR1 this is not a parquet file")
    with open(f"{src}/rows.ndjson", "w") as f:
        f.write('{"id": 3, "name": "c"}\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    got = ig.ingest_files(spark, "t", schema, "id,name", src, f"{tmp_dir}/t", f"{tmp_dir}/l").first()
    assert tuple(got) == (2, 0, 1)
    assert sorted(tuple(r) for r in ig.read_target(spark, f"{tmp_dir}/t", f"{tmp_dir}/l", schema).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    failed = ig.read_ledger(spark, f"{tmp_dir}/l").where("status = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0].file_key.endswith("broken.parquet")
    assert failed[0].error_message.startswith("unreadable parquet file")


def test_missing_or_empty_folders_do_nothing(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("data", T.StringType())])
    os.makedirs(f"{tmp_dir}/only_txt")
    with open(f"{tmp_dir}/only_txt/a.txt", "w") as f:
        f.write("x")
    for folder in ("missing", "only_txt"):
        got = ig.ingest_files(spark, "s.t", schema, "data", f"{tmp_dir}/{folder}", f"{tmp_dir}/t",
                              f"{tmp_dir}/l", file_type="json").first()
        assert tuple(got) == (0, 0, 0)
    assert br.load_landing(spark, f"{tmp_dir}/missing", f"{tmp_dir}/b") == 0
