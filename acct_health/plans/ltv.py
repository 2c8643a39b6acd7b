"""Lifetime-value mart and its summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.functions.dates import month_diff
from acct_health.operators.average import exact_avg, exact_sum
from acct_health.operators.dominant import dominant_value, entity_profile


def dominant_region(fact: DataFrame) -> DataFrame:
    return dominant_value(fact, "customer_id", "order_region", "order_id", "order_date_clean", "dominant_region")


def dominant_market(fact: DataFrame) -> DataFrame:
    return dominant_value(fact, "customer_id", "market", "order_id", "order_date_clean", "dominant_market")


def ltv_base(fact: DataFrame) -> DataFrame:
    """Per customer over dated lines with a valid quantity: revenue (cents), orders,
    first/last order date, lifespan in months (boundaries crossed + 1, at least 1)."""
    f = fact.filter(F.col("order_date_clean").isNotNull() & ~F.col("is_quantity_invalid"))
    return (f.groupBy("customer_id")
            .agg(exact_sum("sales").alias("historical_ltv"),
                 F.count_distinct("order_id").alias("total_orders"),
                 F.min("order_date_clean").alias("first_order_date"),
                 F.max("order_date_clean").alias("last_order_date"))
            .withColumn("lifespan_months", lifespan_months()))


def lifespan_months(first: str = "first_order_date", last: str = "last_order_date") -> Column:
    return F.greatest(month_diff(last, first) + 1, F.lit(1))


def ltv_formula(base: DataFrame) -> DataFrame:
    """AOV (2 dp), orders per month (3 dp), AOV x frequency x lifespan (2 dp)."""
    h, o, life = F.col("historical_ltv"), F.col("total_orders"), F.col("lifespan_months")
    return base.withColumns({
        "avg_order_value": F.round(h / o, 2),
        "purchase_frequency_per_month": F.round(o / life, 3),
        "formula_based_ltv": F.round((h / o) * (o / life) * life, 2),
    })


def mart_ltv(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per-customer LTV with segment (dim, left join on customer_id), dominant region and market.

    One scan of the fact gives the base, the dominant region and the dominant market (``entity_profile``)."""
    base = entity_profile(
        fact, "customer_id", "order_id", "order_date_clean", {"dominant_region": "order_region", "dominant_market": "market"},
        member=~F.col("is_quantity_invalid"), measures={"historical_ltv": F.col("sales")},
        counted="total_orders", first="first_order_date", last="last_order_date").withColumn("lifespan_months", lifespan_months())
    out = ltv_formula(base).join(dim_customer.select("customer_id", "customer_segment"), "customer_id", "left")
    return out.select("customer_id", "customer_segment", "dominant_region", "dominant_market",
                      "historical_ltv", "formula_based_ltv", "avg_order_value", "total_orders",
                      "lifespan_months", "first_order_date", "last_order_date")


def ltv_by(mart: DataFrame, dimension: str, with_formula: bool = True) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("customer_count"),
            F.round(exact_avg("historical_ltv"), 2).alias("avg_historical_ltv")]
    if with_formula:
        aggs.append(F.round(exact_avg("formula_based_ltv"), 2).alias("avg_formula_ltv"))
    return mart.groupBy(dimension).agg(*aggs).orderBy(F.col("avg_historical_ltv").desc_nulls_last(), dimension)


def ltv_formula_check(mart: DataFrame, tolerance: float = 1.0) -> DataFrame:
    return mart.agg(
        F.round(F.corr("historical_ltv", "formula_based_ltv"), 4).alias("correlation"),
        F.count(F.when(F.abs(F.col("historical_ltv") - F.col("formula_based_ltv")) > tolerance, 1)).alias("mismatch_count"),
    )


def ltv_by_engagement(ltv: DataFrame, rfm: DataFrame) -> DataFrame:
    """Average LTV per RFM tier (join of two per-customer marts on customer_id)."""
    j = ltv.select("customer_id", "historical_ltv").join(rfm.select("customer_id", "segment"), "customer_id")
    return j.groupBy("segment").agg(F.count(F.lit(1)).alias("customer_count"),
                                    F.round(exact_avg("historical_ltv"), 2).alias("avg_historical_ltv"))


def slice_mart(df: DataFrame, date_col: str = "order_date_clean", start=None, end=None,
               members: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Dashboard slicers: an inclusive date range plus value lists per column (e.g. segment).
    Plain filters, so they reach the parquet scan as pushed predicates."""
    cond = F.lit(True)
    for col, values in (members or {}).items():
        cond = cond & F.col(col).isin(*values)
    if start is not None:
        cond = cond & (F.col(date_col) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(date_col) <= F.lit(end))
    return df.filter(cond)
