"""Replaceable SQL views over the mart, and parameterised serving SQL.

``register_views`` publishes the mart and its two latest-snapshot views as
temporary views (``CREATE OR REPLACE`` semantics), so SQL users query them by
name. ``country_day_sql`` is the served day query with named parameters:
the country is bound, never spliced into the text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from contrail.operators import serving

# The view names published by ``register_views``.
MART_VIEW = "flight_mart"
LATEST_VIEW = "latest_flight"
LATEST_RANKED_VIEW = "latest_flight_ranked"
HOURLY_VIEW = "flight_analytics"


def register_views(spark: SparkSession, mart: DataFrame, hourly: DataFrame | None = None) -> None:
    mart.createOrReplaceTempView(MART_VIEW)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW {LATEST_VIEW} AS
        SELECT * FROM {MART_VIEW}
        WHERE uploaded_at = (SELECT max(uploaded_at) FROM {MART_VIEW})""")
    # Rank-one rows by load_id, written as the equivalent max filter (no global sort).
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW {LATEST_RANKED_VIEW} AS
        SELECT * FROM {MART_VIEW}
        WHERE load_id = (SELECT max(load_id) FROM {MART_VIEW})""")
    if hourly is not None:
        hourly.createOrReplaceTempView(HOURLY_VIEW)


def country_day_sql(spark: SparkSession, country: str, day: date | str,
                    table: str = HOURLY_VIEW) -> DataFrame:
    """The served day rows of one country, via SQL with named parameters."""
    rows = spark.sql(f"SELECT * FROM {table} WHERE origin_country = :country AND fly_date = CAST(:day AS DATE)",
                     args={"country": country, "day": str(day)})
    return serving.country_day(rows, country, day)
