import datetime as dt

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from contrail.operators.flatten import flatten, state_count
from pyspark.sql import functions as F

# FIXTURES.md section 2: edge snapshots.
EDGE = [
    (1, '{"time":1700000000,"states":[["a00001","AAL12   ","United States",1699999000,1699999990,-71.5,42.25,'
        '1000,false,250.25,90,-0.33,[1,2],1050.5,"1234",false,0],["a00002",null,"France",null,1699999991,null,'
        'null,null,true,0,null,null,null,null,null,false,0]]}'),
    (2, '{"time":1700000300,"states":null}'),
    (3, '{"time":1700000600,"states":[]}'),
    (4, '{"time":1700000900}'),
    (5, 'not json'),
    (6, '{"time":1700001200,"states":[["a00003","BAW9","United Kingdom","x",1700001100,"y","",1e3,"true",12.5,'
        '0,0,null,null,7700,1,"1.5"],["a00004"]]}'),
]


@pytest.fixture()
def bronze(spark):
    rows = [(i, dt.datetime(2023, 11, 14, 22, 0, i), d) for i, d in EDGE]
    return spark.createDataFrame(rows, "load_id long, ingest_time timestamp_ntz, data string")


def test_counts_per_snapshot(bronze):
    got = dict(bronze.select("load_id", state_count(F.col("data"))).collect())
    assert got == {1: 2, 2: 0, 3: 0, 4: 0, 5: 0, 6: 2}


def test_lenient_values(bronze):
    rows = {r["icao24"]: r for r in flatten(bronze).collect()}
    assert set(rows) == {"a00001", "a00002", "a00003", "a00004"}
    a1 = rows["a00001"]
    assert a1["callsign"] == "AAL12   "  # padding kept
    assert a1["time_position"] == dt.datetime(2023, 11, 14, 21, 56, 40)
    assert (a1["longitude"], a1["latitude"], a1["baro_altitude"]) == (-71.5, 42.25, 1000.0)
    assert a1["on_ground"] is False and a1["squawk"] == "1234" and a1["spi"] is False
    assert a1["position_source"] == 0 and a1["geo_altitude"] == 1050.5  # position 12 skipped
    a2 = rows["a00002"]
    assert a2["callsign"] is None and a2["time_position"] is None and a2["on_ground"] is True
    a3 = rows["a00003"]
    assert a3["time_position"] is None and a3["longitude"] is None and a3["latitude"] is None
    assert a3["baro_altitude"] == 1000.0 and a3["on_ground"] is True and a3["squawk"] == "7700"
    assert a3["spi"] is True and a3["position_source"] is None
    a4 = rows["a00004"]
    assert all(a4[c] is None for c in a4.asDict() if c not in ("load_id", "uploaded_at", "icao24"))


def test_legacy_modes(bronze):
    rows = {r["icao24"]: r for r in flatten(bronze, bool_mode="uint8_or_zero", time_mode="or_zero").collect()}
    assert rows["a00003"]["on_ground"] is False  # the text "true" reads as 0
    assert rows["a00003"]["time_position"] == dt.datetime(1970, 1, 1)


def test_strict_mode_raises_on_bad_value(bronze):
    with pytest.raises((PySparkException, Py4JJavaError)):
        flatten(bronze.where("load_id = 6"), mode="strict").collect()
    ok = flatten(bronze.where("load_id = 1"), mode="strict").collect()
    assert len(ok) == 2


def test_cdc_variant_and_rename(bronze):
    from contrail.operators.flatten import rename_id
    cdc = flatten(bronze, id_name="id", cdc_markers=True)
    from contrail.operators.flatten import CDC_MARKERS
    assert cdc.columns[0] == "id" and tuple(cdc.columns[-2:]) == CDC_MARKERS
    assert rename_id(cdc).columns[0] == "load_id"


def test_flatten_is_narrow(bronze):
    plan = flatten(bronze)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "EvalPython" not in plan


def test_malformed_element_keeps_the_rest_of_the_snapshot(spark):
    data = ('{"time":1,"states":[["a00001","X1","France",1700000000],"bad",{"x":1},'
            '["a00002","X2","Spain",null,null,1.5]]}')
    b = spark.createDataFrame([(1, dt.datetime(2023, 11, 14), data)],
                              "load_id long, ingest_time timestamp_ntz, data string")
    rows = flatten(b).collect()
    assert len(rows) == 4 and b.select(state_count(F.col("data"))).first()[0] == 4
    assert sorted(r["icao24"] for r in rows if r["icao24"]) == ["a00001", "a00002"]
    assert sum(1 for r in rows if r["icao24"] is None and r["origin_country"] is None) == 2
    good = {r["icao24"]: r for r in rows if r["icao24"]}
    assert good["a00002"]["longitude"] == 1.5 and good["a00001"]["origin_country"] == "France"
