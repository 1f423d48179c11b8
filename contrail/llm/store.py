"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contrail.session import work_dir


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: it is worked out once and
    survives lost executors."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
