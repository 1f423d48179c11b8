"""Hourly analytics per origin country (and per airline) over airborne reports.

Measures: distinct aircraft (exact ``count(distinct icao24)``), and per-report
averages of velocity and barometric altitude rounded half-even to 2 places
(the mean comes from an exact decimal sum, so it is the same on every run).
Spark plans the distinct count in two phases (partial on (keys, icao24), then
on keys), so a hot country never funnels raw rows into one task.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions.casts import exact_avg, round_ch
from contrail.functions.memo import memo
from contrail.functions.time import ntz_literal

# Fixed value: an airline designator is three letters followed by a digit.
AIRLINE_RE = r"^([A-Z]{3})[0-9]"


def _measures() -> list[Column]:
    return [
        F.count_distinct("icao24").alias("fly_count"),
        round_ch(exact_avg("velocity"), 2).alias("hourly_avg_velocity"),
        round_ch(exact_avg("baro_altitude"), 2).alias("hourly_avg_altitude"),
    ]


def _grouped(mart: DataFrame, key: Column, key_name: str) -> DataFrame:
    date_hour, measures = memo(("hourly",), lambda: (
        [F.to_date("time_position").alias("fly_date"), F.hour("time_position").alias("fly_hour")],
        _measures()))
    return mart.groupBy(key.alias(key_name), *date_hour).agg(*measures)


def hour_bounds(as_of: datetime) -> tuple[datetime, datetime]:
    """The previous complete hour before ``as_of``: [start, end)."""
    end = as_of.replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=1), end


def hourly(mart: DataFrame, start: datetime | None = None,
           end: datetime | None = None) -> DataFrame:
    """Per (origin_country, fly_date, fly_hour) over airborne reports.

    With bounds, only ``start <= time_position < end``; without, every hour
    (reports without a position time have no hour and are left out, as any
    hour range would leave them out).
    """
    m = mart.where(F.col("on_ground") == F.lit(False))  # NULL on_ground is dropped too
    if start is not None:
        m = m.where(F.col("time_position") >= ntz_literal(start))
    if end is not None:
        m = m.where(F.col("time_position") < ntz_literal(end))
    if start is None and end is None:
        m = m.where(F.col("time_position").isNotNull())
    return _grouped(m, F.col("origin_country"), "origin_country")


def hourly_previous(mart: DataFrame, as_of: datetime) -> DataFrame:
    """The export job's query: the previous full hour, ordered for output."""
    start, end = hour_bounds(as_of)
    return hourly(mart, start, end).orderBy("fly_hour", "origin_country")


def airline_hourly(mart: DataFrame) -> DataFrame:
    """Same measures grouped by airline designator (callsign prefix)."""
    m = mart.where((F.col("on_ground") == F.lit(False)) & F.col("time_position").isNotNull())
    airline = F.regexp_extract(F.col("callsign"), AIRLINE_RE, 1)
    return _grouped(m.where(airline != ""), airline, "airline")
