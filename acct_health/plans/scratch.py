"""Intermediate tables in the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from acct_health.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path under ``spark.checkpoint.dir``; raises off local masters if that is not set."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/acct_health_tables/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` there and read it back: its lineage ends, and it is computed once."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
