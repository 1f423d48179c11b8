"""Inputs that earlier versions got wrong."""

import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from contrail import streaming as st
from contrail.functions.casts import exact_avg, strict_double
from contrail.operators import backfill as bf
from contrail.operators.flatten import flatten
from contrail.plans import catalog
from contrail.sources import bronze as br
from contrail.sources import ingest as ig
from contrail.sources.bronze import payload_time
from contrail.sources.csv_blocks import read_csv
from contrail.sources.ingest import list_files
from tests.conftest import SF_SMALL, sorted_rows


@pytest.mark.parametrize("values, want", [
    ([1e33, 1.0], 5e32), ([float("inf"), 1.0], math.inf), ([1e-7, 2e-7, 3e-7], 2e-7), ([9e31, 9e31], 9e31),
    ([0.1, 0.2, None], 0.15), ([None], None)])
def test_mean_counts_every_value(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(exact_avg("v").alias("m")).first()["m"]
    assert got is None if want is None else got == pytest.approx(want)


def test_strict_double_refuses_type_suffixes(spark):
    df = spark.createDataFrame([("1.5",), (None,)], "v string")
    assert [r[0] for r in df.select(strict_double("v")).collect()] == [1.5, None]
    with pytest.raises(Exception, match="not a number"):
        spark.createDataFrame([("1d",)], "v string").select(strict_double("v")).collect()


def test_absurd_payload_time_reads_null(spark):
    df = spark.createDataFrame([('{"time": 999999999999999999}',), ('{"time": 1700000000}',), ("{}",)], "data string")
    got = [r[0] for r in df.select(payload_time(F.col("data"))).collect()]
    assert got[0] is None and got[1] is not None and got[2] is None


def test_csv_goes_by_each_files_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b\nA1,B1\n')
    (tmp_path / "2.csv").write_text('b,a\nB2,"say ""hi"" now"\n')
    (tmp_path / "3.csv").write_text('a,junk\n"two\nlines",J\n')
    (tmp_path / "4.csv").write_text('')
    got = read_csv(list_files(spark, str(tmp_path)), ["a", "b"]).select("a", "b").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("A1", "B1"), ('say "hi" now', "B2"), ("two\nlines", None)], key=str)


def test_bad_number_text_is_found(spark):
    df = spark.createDataFrame([("1d",), ("",), ("2.5",), (None,)], "x string")
    assert [r[0] for r in df.select(ig._bad_value("x", T.DoubleType())).collect()] == [True, True, False, False]


def test_one_mart_for_stream_and_batch_in_either_order(spark, tmp_dir):
    bronze = catalog._staged_bronze(spark, SF_SMALL, tmp_dir)
    whole = br.read_bronze(spark, bronze)
    want = sorted_rows(catalog._mart(spark, SF_SMALL))
    half = whole.where("load_id % 2 = 0")
    for name, steps in (("a", "bs"), ("b", "sb"), ("c", "bsb")):
        mart = f"{tmp_dir}/mart_{name}"
        for step in steps:
            if step == "b":
                bf.backfill(spark, half, mart)
            else:
                catalog._await(st.flatten_stream(spark, bronze, mart, f"{tmp_dir}/ck_{name}", trigger="available_now"))
        assert sorted_rows(bf.read_mart(spark, mart)) == want


def test_replayed_micro_batch_adds_nothing(spark, tmp_dir):
    bronze = br.read_bronze(spark, catalog._staged_bronze(spark, SF_SMALL, tmp_dir))
    rows = flatten(bronze)
    for _ in range(2):  # the same micro-batch written twice, as after a crash before its mark
        bf.write_mart_batch(rows, f"{tmp_dir}/mart", "stream-0")
    assert bf.read_mart(spark, f"{tmp_dir}/mart").count() == rows.count()


def test_ingest_glob_names_and_parquet_type_conflicts(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a[1].csv").write_text("id\n1\n")
    (land / "a{2}*.ndjson").write_text('{"id": 2}\n')
    (land / "x?[3].json").write_text('{"id": 3}')
    pq.write_table(pa.table({"id": pa.array([4], pa.int64())}), land / "p[4].parquet")
    pq.write_table(pa.table({"id": pa.array(["5"])}), land / "q.parquet")
    pq.write_table(pa.table({"id": pa.array(["none"])}), land / "r.parquet")
    (land / "s.parquet").write_text("no parquet at all")
    schema = T.StructType([T.StructField("id", T.LongType())])
    got = ig.ingest_files(spark, "t", schema, "id", str(land), f"{tmp_path}/t", f"{tmp_path}/ledger").first()
    assert tuple(got) == (5, 0, 2)
    assert sorted(r[0] for r in ig.read_target(spark, f"{tmp_path}/t", f"{tmp_path}/ledger", schema).collect()) == [1, 2, 3, 4, 5]
    state = {r["file_key"].rsplit("/", 1)[1]: r["status"] for r in ig.read_ledger(spark, f"{tmp_path}/ledger").collect()}
    assert state["r.parquet"] == state["s.parquet"] == "FAILED"


def test_landing_names_with_glob_characters(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for i in range(8):
        (land / f"n{i}.json").write_text('{"time": 1700000000, "states": []}')
    assert br.load_landing(spark, str(land), f"{tmp_path}/bronze") == 8
    (land / "snap[9].json").write_text('{"time": 1700000001, "states": []}')
    assert br.load_landing(spark, str(land), f"{tmp_path}/bronze") == 1
    assert br.read_bronze(spark, f"{tmp_path}/bronze").count() == 9
