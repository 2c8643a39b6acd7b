"""Generated calendar spine (one row per day)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "full_date") -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive; size is (end - start) + 1 rows,
    known before running; none if ``end`` is before ``start``."""
    if end < start:
        return spark.createDataFrame([], f"{name} date")
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias(name)
    )
