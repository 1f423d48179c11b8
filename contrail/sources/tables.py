"""Read the driver-provided parquet tables with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """A driver table, with its fixed schema when known (no footer inference)."""
    from contrail.schemas import DRIVER_TABLES
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def sql_frame(spark: SparkSession, text: str, args: dict | None = None,
              name: str = "rows"):
    """SQL text -> (DataFrame, Observation with its row count).

    The count is collected as a side metric of whatever action runs the
    frame (``observe``), so no second pass over the data is needed; read it
    with ``observation.get[name]`` after the action. Errors propagate.
    """
    from pyspark.sql import Observation, functions as F
    obs = Observation(name)
    df = spark.sql(text, args=args) if args else spark.sql(text)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs
