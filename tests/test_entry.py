"""Driver contract: entry, queries and oracle keys; oracle parity at sf0.001."""

import os
import sys

import pytest

import __spark_entry__ as entry
from contrail.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["origin_country", "fly_date", "fly_hour", "fly_count",
                          "hourly_avg_velocity", "hourly_avg_altitude"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


FAST = ["flatten_states", "flatten_strict", "flatten_cdc", "snapshot_counts", "json_access",
        "cast_lenient", "latest_watermark", "latest_rank", "snapshot_asof", "hourly_prev", "hourly_all",
        "airline_hourly", "country_day", "country_day_total", "countries", "live_points",
        "run_log_recent", "alerts", "ingest_listing"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity_small(spark, name):
    import oracle_check
    assert oracle_check.compare(spark, SF_SMALL, {name})


WRITING = sorted(set(QUERIES) - set(FAST))


@pytest.mark.parametrize("name", WRITING)
def test_oracle_parity_small_writing_queries(spark, name):
    """The queries that write landing files, sinks, ledgers or streams."""
    import oracle_check
    assert oracle_check.compare(spark, SF_SMALL, {name})


BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
          "WindowGroupLimit")


@pytest.mark.parametrize("name", FAST)
def test_registered_plans_stay_jvm_side(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in BANNED:
        assert node not in plan, (name, node)
