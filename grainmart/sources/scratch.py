"""Intermediate tables of one application, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from grainmart.config import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table: read again instead of computed again, and still there if executors are lost."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
