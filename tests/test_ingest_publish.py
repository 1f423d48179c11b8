"""One publish for rows and ledger, whole listings, CSV in blocks, damaged files, defaults."""

import csv
import io
import os
import random
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from contrail.sources import csv_blocks, listing, manifest
from contrail.sources import ingest as ig
from contrail.sources.listing import list_tree

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def load(spark, base, **kw):
    return tuple(ig.ingest_files(spark, "s.t", SCHEMA, "id,name", f"{base}/src", f"{base}/t", f"{base}/l", **kw).first())


def rows(spark, base):
    return sorted(tuple(r) for r in ig.read_target(spark, f"{base}/t", f"{base}/l", SCHEMA).collect())


def state(spark, base):
    return {r["file_key"].rsplit("/", 1)[1]: (r["status"], r["error_message"]) for r in ig.read_ledger(spark, f"{base}/l").collect()}


def put(base, files):
    for name, text in files.items():
        path = f"{base}/src/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())


def test_stopped_run_leaves_nothing(spark, tmp_dir, monkeypatch):
    put(tmp_dir, {"a.ndjson": '{"id": 1, "name": "x"}\n', "b.csv": "id,name\n2,y\n", "c.csv": "id,name\nz,y\n"})

    def stop(*a, **k):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(ig.manifest, "publish", stop)  # rows and ledger rows are written, but not published
        with pytest.raises(RuntimeError):
            load(spark, tmp_dir)
    assert os.listdir(f"{tmp_dir}/t") and rows(spark, tmp_dir) == [] and state(spark, tmp_dir) == {}
    with monkeypatch.context() as m:
        m.setattr(ig.Load, "_write_rows", stop)  # nothing but listings before
        with pytest.raises(RuntimeError):
            load(spark, tmp_dir)
    assert load(spark, tmp_dir) == (2, 0, 1)
    assert rows(spark, tmp_dir) == [(1, "x"), (2, "y")]
    assert load(spark, tmp_dir) == (0, 2, 1)
    assert rows(spark, tmp_dir) == [(1, "x"), (2, "y")]
    assert ig.discard_unpublished(spark, f"{tmp_dir}/t", f"{tmp_dir}/l") == 2  # the first run's rows and ledger rows
    assert rows(spark, tmp_dir) == [(1, "x"), (2, "y")]


def test_of_two_runs_at_once_one_starts_over(spark, tmp_dir, monkeypatch):
    put(tmp_dir, {"a.ndjson": '{"id": 1, "name": "x"}\n'})
    publish, calls = manifest.publish, []

    def overtaken(spark_, root, seen, new):
        if not calls:
            calls.append(1)
            assert load(spark, tmp_dir) == (1, 0, 0)  # another run loads the same file and publishes first
        return publish(spark_, root, seen, new)
    monkeypatch.setattr(ig.manifest, "publish", overtaken)
    assert load(spark, tmp_dir) == (0, 1, 0)
    assert rows(spark, tmp_dir) == [(1, "x")]


def test_hidden_and_empty_files_count(spark, tmp_dir, monkeypatch):
    put(tmp_dir, {"good.json": '[{"id": 1, "name": "a"}]', "_x.json": '[{"id": 2, "name": "b"}]', ".y.csv": "id,name\n3,c\n", "empty.json": ""})
    assert load(spark, tmp_dir) == (3, 0, 1)
    assert rows(spark, tmp_dir) == [(1, "a"), (2, "b"), (3, "c")]
    assert state(spark, tmp_dir)["empty.json"] == ("FAILED", "the file is empty")
    put(tmp_dir, {"_d/e/_z.ndjson": '{"id": 4, "name": "d"}\n', "empty.csv": "", "empty.ndjson": "", ".json": "no extension", "e.parquet": ""})
    assert load(spark, tmp_dir) == (3, 3, 2)
    assert rows(spark, tmp_dir)[-1] == (4, "d")
    assert list_tree(spark, f"{tmp_dir}/src").count() == 9
    monkeypatch.setattr(listing, "ENTRIES", 1)  # a round for each folder
    assert list_tree(spark, f"{tmp_dir}/src").count() == 9
    assert list_tree(spark, f"{tmp_dir}/nowhere").count() == 0


def damaged(table, path):
    """A Parquet file whose footer is whole and one of whose pages is not."""
    sink = io.BytesIO()
    pq.write_table(table, sink, row_group_size=500, compression="zstd", use_dictionary=False)
    data = bytearray(sink.getvalue())
    meta = pq.ParquetFile(io.BytesIO(bytes(data))).metadata.row_group(1).column(0)
    at = meta.data_page_offset
    data[at:at + meta.total_compressed_size] = b"\xff" * meta.total_compressed_size
    with open(path, "wb") as f:
        f.write(bytes(data))


def test_damaged_pages_fail_their_file_alone(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    table = pa.table({"id": pa.array(range(2000), pa.int64()), "name": pa.array([f"n{i * 7919 % 2000}" for i in range(2000)])})
    damaged(table, f"{tmp_dir}/src/a.parquet")
    pq.write_table(table.slice(0, 3), f"{tmp_dir}/src/b.parquet")
    put(tmp_dir, {"c.csv": "name,id\nq,9\n", "d.parquet": b"PAR1 but no more"})
    assert load(spark, tmp_dir) == (2, 0, 2)
    assert rows(spark, tmp_dir) == [(0, "n0"), (1, "n1919"), (2, "n1838"), (9, "q")]
    got = state(spark, tmp_dir)
    assert got["a.parquet"] == ("FAILED", "unreadable parquet file: pages are damaged")
    assert got["d.parquet"][0] == "FAILED" and got["d.parquet"][1].startswith("unreadable parquet file")


def test_defaults_of_columns_that_are_not_loaded(spark, tmp_dir):
    schema = T.StructType([T.StructField("load_id", T.LongType()), T.StructField("ingest_time", T.TimestampNTZType()),
                           T.StructField("data", T.StringType())])
    put(tmp_dir, {"b.ndjson": '{"data": {"k": 3}}\n{"data": "4"}\n', "a.json": '[{"data": "1"}, {"data": "2"}]'})
    now = datetime(2026, 1, 2, 3, 4, 5)
    run = lambda: ig.ingest_files(spark, "s.t", schema, "data", f"{tmp_dir}/src", f"{tmp_dir}/t", f"{tmp_dir}/l", now=now,
                                  defaults={"load_id": ig.SERIAL, "ingest_time": ig.NOW}).first()
    assert tuple(run()) == (2, 0, 0)
    put(tmp_dir, {"0.json": '{"data": "5"}'})
    assert tuple(run()) == (1, 2, 0)
    got = sorted(tuple(r) for r in ig.read_target(spark, f"{tmp_dir}/t", f"{tmp_dir}/l", schema).collect())
    assert got == [(1, now, "1"), (2, now, "2"), (3, now, '{"k": 3}'), (4, now, "4"), (5, now, "5")]
    with pytest.raises(ValueError):
        ig.ingest_files(spark, "s.t", schema, "data", tmp_dir, f"{tmp_dir}/t", f"{tmp_dir}/l", defaults={"load_id": "random"})


def by_module(text, cols):
    return [tuple(r.get(c) for c in cols) for r in csv.DictReader(io.StringIO(text, newline=""))]


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_csv_blocks_equal_the_csv_module(spark, tmp_path, block):
    rng = random.Random(block)
    cells = ["", "x", "two\nlines", 'say "hi"', ",", '"', '""', "\n\n", "é\r\n日本", "plain", 'a"b', "y" * 50]
    want, texts = [], {}
    for k in range(4):
        out = io.StringIO()
        w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        names = [["a", "b", "c"], ["b", "a", "junk\nname"], ["c", "x", "a"], ["a", "a", "b"]][k]
        w.writerow(names)
        for _ in range(rng.randrange(40)):
            w.writerow([rng.choice(cells) for _ in range(rng.choice([3, 3, 3, 2, 4]))])
            if rng.random() < 0.1:
                out.write("\n")
        texts[f"{k}.csv"] = out.getvalue().rstrip("\n") if k == 1 else out.getvalue()
    texts |= {"quote.csv": 'a,b\n5" pipe,x"y\n"in" side,2\n', "bom.csv": "﻿\n\na,b\n1,2\n", "open.csv": 'a,b\n1,"never closed\nand on\n',
              "head.csv": "a,b", "empty.csv": "", "blank.csv": "\n\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
        want += by_module(text.lstrip("﻿\n"), ["a", "b", "c"])
    got = csv_blocks.read_csv(ig.list_files(spark, str(tmp_path)), ["a", "b", "c"], block).select("a", "b", "c").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_large_csv_spreads_over_tasks(spark, tmp_path):
    with open(tmp_path / "large.csv", "w") as f:
        f.write("id,name\n")
        for i in range(200_000):
            f.write(f'{i},"line\nof ""{i}"""\n')
    df = csv_blocks.read_csv(ig.list_files(spark, str(tmp_path)), ["id", "name"], 256 << 10)
    n = df.withColumn("task", F.spark_partition_id()).selectExpr("count(*)", "sum(cast(id as long))", "count_if(name = concat('line\\nof \"', id, '\"'))",
                      "count(distinct task)").first()
    assert tuple(n)[:3] == (200_000, 200_000 * 199_999 // 2, 200_000) and n[3] >= 8
