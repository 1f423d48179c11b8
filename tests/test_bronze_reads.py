"""Landing loads: ids fix who reads what, payloads do not move, hidden and empty files count."""

import os

from pyspark.sql import functions as F

from contrail.sources import bronze as br
from contrail.sources.listing import list_tree


def land(folder, files):
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)


def test_no_exchange_above_the_payload_read(spark, tmp_dir):
    land(f"{tmp_dir}/land", {f"{i:03d}.json": '{"time": %d, "states": [["a"]]}' % (1700000000 + 3600 * i) for i in range(40)})
    numbered = br.number_files(list_tree(spark, f"{tmp_dir}/land").withColumnRenamed("file_key", "source_file"), "path", 100)
    rows = br.bronze_rows(br.read_payloads(numbered))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert "Exchange" not in above and "Join" not in above
    got = rows.orderBy("load_id").collect()
    assert [r["load_id"] for r in got] == list(range(101, 141))
    assert [os.path.basename(r["source_file"]) for r in got] == [f"{i:03d}.json" for i in range(40)]
    assert all(r["data"].startswith('{"time": %d' % (1700000000 + 3600 * i)) for i, r in enumerate(got))


def test_hidden_and_empty_landing_files_are_loaded(spark, tmp_dir):
    land(f"{tmp_dir}/land", {"_a.json": '{"time": 1700000000, "states": []}', ".b.json": "{}", "d/c.json": "", "d/_e/f.json": "é not json"})
    assert br.load_landing(spark, f"{tmp_dir}/land", f"{tmp_dir}/bronze", order_by="path") == 4
    rows = br.read_bronze(spark, f"{tmp_dir}/bronze")
    assert sorted(r["data"] for r in rows.collect()) == ["", '{"time": 1700000000, "states": []}', "{}", "é not json"]
    assert sorted(r[0] for r in br.snapshot_sizes(rows).select("n_states").collect()) == [0, 0, 0, 0]
    assert br.load_landing(spark, f"{tmp_dir}/land", f"{tmp_dir}/bronze", order_by="path") == 0
    assert rows.agg(F.max("load_id")).first()[0] == 4


def test_large_payloads_are_passed_on_one_by_one(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(br, "BATCH_BYTES", 1000)
    monkeypatch.setattr(br, "TASK_BYTES", 5000)
    land(f"{tmp_dir}/land", {f"{i}.json": str(i) * (300 + 100 * i) for i in range(10)})
    assert br.load_landing(spark, f"{tmp_dir}/land", f"{tmp_dir}/bronze", order_by="path", count_states=False) == 10
    got = {r["load_id"]: r["data"] for r in br.read_bronze(spark, f"{tmp_dir}/bronze").collect()}
    assert got == {i + 1: str(i) * (300 + 100 * i) for i in range(10)}
