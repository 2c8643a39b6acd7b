"""RFM churn mart: recency / frequency / monetary quintiles and engagement tiers."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.functions.dates import REFERENCE_CEILING
from acct_health.operators.average import exact_avg, exact_sum
from acct_health.operators.ntile import ntile_many

# Churn threshold (days) and tier thresholds on the 3..15 score.
CHURN_DAYS = 90
TIERS: tuple[tuple[int, str], ...] = ((12, "Growing"), (9, "Stable"), (6, "At Risk"))
LOWEST_TIER = "Lapsed"
AT_RISK_TIERS: tuple[str, ...] = ("At Risk", "Lapsed")


def rfm_base(fact: DataFrame, snapshot: dt.date = REFERENCE_CEILING) -> DataFrame:
    """Per customer over dated lines with a valid quantity: recency days, distinct orders,
    revenue (added as decimals, so the value is exact and order-independent), mean delay.

    The one distinct count plans as aggregate by (customer, order) then by customer, both
    with map-side partial aggregation, so a hot customer is reduced before shuffling.
    """
    f = fact.filter(F.col("order_date_clean").isNotNull() & ~F.col("is_quantity_invalid"))
    return f.groupBy("customer_id").agg(
        F.datediff(F.lit(snapshot), F.max("order_date_clean")).alias("recency_days"),
        F.count_distinct("order_id").alias("frequency"),
        exact_sum("sales").alias("monetary"),
        F.avg(F.col("real_shipping_days") - F.col("scheduled_days_for_shipment")).alias("avg_delivery_delay"),
    )


# each ranking ends with the customer, so it is unique
RANKINGS = {
    "r_score": (("recency_days", True), ("customer_id", False)),
    "f_score": (("frequency", False), ("customer_id", False)),
    "m_score": (("monetary", False), ("customer_id", False)),
}


def rfm_scores(base: DataFrame, k: int = 5) -> DataFrame:
    """r_score (recency DESC), f_score, m_score (ASC) as global NTILE(k), customer_id tie-break.

    Runs jobs: the keys at which scores begin are selected for the three rankings together, from ``base`` kept in
    Spark's cache meanwhile (computed once; a lost executor's part is computed again). The scores are then comparisons with literals."""
    held = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scored = ntile_many(held, k, RANKINGS)
    finally:
        held.unpersist()
    return scored


def churn_flag(recency: Column | str = "recency_days", days: int = CHURN_DAYS) -> Column:
    r = F.col(recency) if isinstance(recency, str) else recency
    return F.coalesce(r > days, F.lit(False))


def rfm_segment(score: Column | str = "rfm_score") -> Column:
    s = F.col(score) if isinstance(score, str) else score
    out = None
    for threshold, name in TIERS:
        out = F.when(s >= threshold, F.lit(name)) if out is None else out.when(s >= threshold, F.lit(name))
    return out.otherwise(F.lit(LOWEST_TIER))


def mart_churn_rfm(fact: DataFrame, snapshot: dt.date = REFERENCE_CEILING, base: DataFrame | None = None) -> DataFrame:
    """Per-customer RFM scores, churn flag and tier."""
    s = rfm_scores(base if base is not None else rfm_base(fact, snapshot)).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    return s.select("customer_id", "recency_days", "frequency", "monetary", "avg_delivery_delay",
                    "r_score", "f_score", "m_score", "rfm_score",
                    churn_flag().alias("is_churned"), rfm_segment().alias("segment"))


def segment_summary(mart: DataFrame) -> DataFrame:
    out = mart.groupBy("segment").agg(F.count(F.lit(1)).alias("customer_count"),
                                      F.round(exact_avg("monetary"), 2).alias("avg_monetary"))
    return out.orderBy(F.col("avg_monetary").desc_nulls_last(), "segment")


def segment_churn_crosstab(mart: DataFrame) -> DataFrame:
    return mart.groupBy("segment", "is_churned").agg(F.count(F.lit(1)).alias("cnt")).orderBy("segment", "is_churned")


def kpi_at_risk_pct(mart: DataFrame, tiers=AT_RISK_TIERS) -> DataFrame:
    risk = F.col("segment").isin(*tiers)
    return mart.agg(F.count(F.when(risk, 1)).alias("at_risk_accounts"),
                    F.count(F.lit(1)).alias("total_accounts"),
                    F.round(F.avg(risk.cast("double")) * 100, 2).alias("at_risk_pct"))


def risk_call_list(mart: DataFrame, n: int = 50, tiers=AT_RISK_TIERS) -> DataFrame:
    """Top-n at-risk accounts by value (a top-k report: the limit is the feature).
    Plans as TakeOrderedAndProject: each task keeps its n best, the driver merges n * tasks."""
    return (mart.filter(F.col("segment").isin(*tiers))
            .orderBy(F.col("monetary").desc_nulls_last(), F.col("customer_id").asc())
            .limit(n)
            .select("customer_id", "segment", "monetary", "recency_days", "frequency", "rfm_score"))


def risk_table_with_total(mart: DataFrame) -> DataFrame:
    """Accounts and average value per tier plus a 'Total' row (ROLLUP)."""
    return (mart.rollup("segment")
            .agg(F.count(F.lit(1)).alias("accounts"), F.round(exact_avg("monetary"), 2).alias("avg_monetary"),
                 F.grouping("segment").alias("__g"))
            .select(F.when(F.col("__g") == 1, F.lit("Total")).otherwise(F.col("segment")).alias("segment"),
                    "accounts", "avg_monetary"))
