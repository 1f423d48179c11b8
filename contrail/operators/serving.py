"""Serving reads: live points of the latest snapshot and per-country day views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from contrail.functions.casts import exact_avg, round_ch

# Display labels of the day view (fixed values).
DAY_LABELS = {
    "fly_date": "Date",
    "fly_hour": "Hour",
    "flights": "Daily Flights",
    "avg_altitude": "Daily Avg Altitude (m)",
    "avg_velocity": "Daily Avg Velocity (m/s)",
}


def live_points(latest: DataFrame, country: str | None = None) -> DataFrame:
    """Latest positions with a usable location, optionally for one country."""
    df = latest.dropna(subset=["latitude", "longitude", "origin_country"])
    if country is not None:
        df = df.where(F.col("origin_country") == F.lit(country))
    return df.withColumns({"latitude": F.col("latitude").cast("double"),
                           "longitude": F.col("longitude").cast("double")})


def countries(latest: DataFrame) -> DataFrame:
    """Sorted distinct countries that have live points."""
    return live_points(latest).select("origin_country").distinct().orderBy("origin_country")


def country_day(hourly_gold: DataFrame, country: str, day: date | str) -> DataFrame:
    """One country's hourly rows for one day; the country is a bound literal."""
    day_lit = F.lit(str(day)).cast("date")
    return (hourly_gold
            .where((F.col("origin_country") == F.lit(country)) & (F.col("fly_date") == day_lit))
            .select("fly_date",
                    F.round("fly_hour", 0).cast("int").alias("fly_hour"),
                    F.col("fly_count").alias("flights"),
                    F.round("hourly_avg_altitude", 2).alias("avg_altitude"),
                    F.round("hourly_avg_velocity", 2).alias("avg_velocity"))
            .orderBy("fly_hour"))


def with_total(day_rows: DataFrame) -> DataFrame:
    """Append the day total: summed hourly counts, unweighted mean of hourly means.

    Not a roll-up of reports: an aircraft seen in two hours counts twice, and
    the averages are means of already-rounded hourly means. One aggregation
    with grouping sets ((fly_date, fly_hour), ()) yields the hour rows (one
    row per hour, so each aggregate is that hour's value) and the total, so
    the day rows are computed once. Date and hour become text so the
    ``Total`` label fits the column; a day without rows gets no total.
    """
    g = (day_rows.groupingSets([["fly_date", "fly_hour"], []], "fly_date", "fly_hour")
         .agg(F.sum("flights").cast("bigint").alias("flights"),
              round_ch(exact_avg("avg_altitude"), 2).alias("avg_altitude"),
              round_ch(exact_avg("avg_velocity"), 2).alias("avg_velocity"),
              F.count("*").alias("_n"),
              F.grouping_id().alias("_total")))
    is_total = F.col("_total") != 0
    return (g.where(~is_total | (F.col("_n") > 0))
            .select(F.when(is_total, F.lit("Total")).otherwise(F.col("fly_date").cast("string")).alias("fly_date"),
                    F.when(is_total, F.lit("")).otherwise(F.col("fly_hour").cast("string")).alias("fly_hour"),
                    "flights", "avg_altitude", "avg_velocity"))


def labelled(day_view: DataFrame) -> DataFrame:
    """Rename columns to their display labels."""
    return day_view.withColumnsRenamed({k: v for k, v in DAY_LABELS.items() if k in day_view.columns})
