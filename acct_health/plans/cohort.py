"""Monthly acquisition-cohort retention mart (right-censored)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acct_health.functions.dates import REFERENCE_CEILING, month_diff
from acct_health.operators.average import exact_avg
from acct_health.operators.month_bits import month_array, month_words


def drop_censored(df: DataFrame, ceiling: dt.date = REFERENCE_CEILING) -> DataFrame:
    """Keep (cohort, index) cells whose month is complete: cohort + index months <= ceiling - 1 month."""
    limit = F.add_months(F.lit(ceiling), -1)
    return df.filter(F.add_months("cohort_month", F.col("month_index")) <= limit)


def cohort_index(months: DataFrame, entity: str = "customer_id", active: str = "months") -> DataFrame:
    """(entity, cohort_month, month_index) for each month of an entity's array of distinct active months: the
    cohort is the first one, the index the months since then."""
    cells = months.select(entity, F.array_min(active).alias("cohort_month"), F.explode(active).alias("__month"))
    return cells.select(entity, "cohort_month", month_diff("__month", "cohort_month").alias("month_index"))


def mart_cohort(fact: DataFrame, ceiling: dt.date = REFERENCE_CEILING, entity: str = "customer_id",
                date: str = "order_date_clean", first: dt.date | None = None) -> DataFrame:
    """cohort_month, month_index, active_customers, cohort_size, retention_pct.

    Plan (three exchanges, none carrying raw lines): a customer's active months are a bit set of a few bytes, OR-ed map-side, so each task ships
    one small row a customer; customers with equal sets are then counted as one, and only the distinct sets are taken apart into
    (cohort, month index) cells. Cohort size comes from a window over the small (cohort, index) table instead of a self join.
    Months after the ceiling's are censored anyway and not looked at. ``first``: the first month of the data; a job finds
    the earliest date (one row) if it is not given.
    """
    if first is None:
        first = fact.agg(F.min(date)).first()[0] or ceiling
    first = min(first, ceiling).replace(day=1)
    aggs = month_words(date, first, ceiling)
    words = [f"__w{i}" for i in range(len(aggs))]
    sets = fact.filter(F.col(date).isNotNull()).groupBy(entity).agg(*aggs)
    sets = sets.groupBy(*words).agg(F.count(entity).alias("__n"))  # a null entity is nobody
    activity = (cohort_index(sets.select("__n", month_array(words, first).alias("__months")).where("size(__months) > 0"), "__n", "__months")
                .groupBy("cohort_month", "month_index")
                .agg(F.sum("__n").alias("active_customers")))
    size = F.max(F.when(F.col("month_index") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month"))
    out = activity.withColumn("cohort_size", size).filter(F.col("cohort_size").isNotNull())
    out = drop_censored(out, ceiling)
    return out.select(
        "cohort_month", "month_index", "active_customers", "cohort_size",
        F.round(F.try_divide(F.col("active_customers"), F.col("cohort_size")) * 100, 2).alias("retention_pct"),
    )


def cohort_curve(mart: DataFrame, cohort_month: dt.date) -> DataFrame:
    return mart.filter(F.col("cohort_month") == F.lit(cohort_month)).orderBy("month_index")


def retention_rate(mart: DataFrame) -> DataFrame:
    """The retention measure per cohort month and month index: SUM(retention_pct) / 100, a fraction."""
    total = F.sum(F.col("retention_pct").cast("decimal(28,2)")).cast("double")
    return (mart.groupBy("cohort_month", "month_index").agg((total / 100).alias("retention_rate"))
            .orderBy("cohort_month", "month_index"))


def cohort_matrix(mart: DataFrame, max_index: int | None = None) -> DataFrame:
    """Wide heatmap: one row per cohort, columns m0..mN of retention_pct.

    The column list is fixed up front (one-row ``max`` when not given), so ``pivot`` needs
    no extra distinct pass.
    """
    if max_index is None:
        max_index = mart.agg(F.max("month_index")).first()[0] or 0
    idx = list(range(max_index + 1))
    wide = mart.groupBy("cohort_month").pivot("month_index", idx).agg(F.first("retention_pct"))
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"m{i}") for i in idx])


def kpi_retention(mart: DataFrame, min_index: int = 1) -> DataFrame:
    """Retention KPI (own definition; the reference's dashboard formula is not published):
    mean retention_pct over cells with month_index >= ``min_index``, plus the month-1 mean."""
    return mart.agg(
        F.round(exact_avg(F.when(F.col("month_index") >= min_index, F.col("retention_pct"))), 2).alias("retention_kpi_pct"),
        F.round(exact_avg(F.when(F.col("month_index") == 1, F.col("retention_pct"))), 2).alias("month1_retention_pct"),
        F.count(F.when(F.col("month_index") >= min_index, 1)).alias("cells"),
    )
