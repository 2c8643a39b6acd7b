"""Star schema: order-line fact with ceiling correction, calendar, customer and product dims."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acct_health.functions.dates import REFERENCE_CEILING, date_key, swap_impossible_date
from acct_health.functions.flags import flag_out_of_order
from acct_health.operators.dedupe import TIED
from acct_health.operators.latest import latest_non_null
from acct_health.sources.calendar import date_spine

# The reference's calendar range.
REFERENCE_CALENDAR = (dt.date(2024, 1, 1), dt.date(2026, 12, 31))

# fact column <- staging column, in the fact's column order (after the date columns).
_FACT_ATTRS = (
    ("order_status", "order_status_clean"), ("delivery_status", "delivery_status_clean"),
    ("shipping_mode", "shipping_mode_clean"), ("order_region", "order_region_clean"),
    ("order_state", "order_state_clean"), ("order_country", "order_country_clean"),
    ("market", "market_clean"), ("real_shipping_days", "real_shipping_days_clean"),
    ("scheduled_days_for_shipment", "scheduled_days_for_shipment_clean"),
    ("late_delivery_risk", "late_delivery_risk_clean"), ("sales", "sales_clean"),
    ("order_item_total", "order_item_total_clean"), ("order_item_product_price", "order_item_product_price_clean"),
    ("order_item_discount", "order_item_discount_clean"),
    ("order_item_discount_rate", "order_item_discount_rate_clean"),
    ("order_profit_per_order", "order_profit_per_order_clean"), ("benefit_per_order", "benefit_per_order_clean"),
    ("order_item_profit_ratio", "order_item_profit_ratio_clean"),
    ("sales_per_customer", "sales_per_customer_clean"), ("order_item_quantity", "order_item_quantity_clean"),
)
_CARRIED_FLAGS = (
    "is_shipping_mode_missing", "is_order_status_missing", "is_delivery_status_missing",
    "is_late_risk_missing", "is_real_days_missing", "is_scheduled_days_missing",
    "is_sales_missing", "is_order_item_total_missing", "is_product_price_missing",
    "is_discount_missing", "is_profit_per_order_missing", "is_benefit_per_order_missing",
    "is_sales_per_customer_missing", "is_discount_rate_missing", "is_profit_ratio_missing",
    "is_quantity_missing", "is_quantity_invalid",
    "is_segment_missing", "is_region_missing", "is_market_missing", "is_country_missing", "is_state_missing",
)


_DATES = ("order_date_clean", "shipping_date_clean")


def fact_sources(columns: Sequence[str]) -> list[str]:
    """The staging columns that ``build_fact`` needs for some of the fact's columns."""
    renamed = dict(_FACT_ATTRS)
    dated = {"order_date_key", "shipping_date_key", "is_order_date_missing", "is_shipping_date_missing", "is_ship_before_order_flag", *_DATES}
    return list(dict.fromkeys([*_DATES, *[renamed.get(c, c) for c in columns if c not in dated]]))


FACT_COLUMNS = ("order_item_id", "order_id", "customer_id", "product_card_id", "order_date_key", "shipping_date_key", *_DATES,
                *[c for c, _ in _FACT_ATTRS], "is_order_date_missing", "is_shipping_date_missing", "is_ship_before_order_flag", *_CARRIED_FLAGS)


def build_fact(stg: DataFrame, ceiling: dt.date = REFERENCE_CEILING, null_if_still_after: bool = False,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Order-line fact (53 columns): dates past the ceiling corrected, date keys, renamed
    measures, date flags re-derived on the corrected dates. Narrow: no shuffle.
    ``columns``: only these, from a ``stg`` that has at least their sources (``fact_sources``)."""
    od = swap_impossible_date("order_date_clean", ceiling, null_if_still_after)
    sd = swap_impossible_date("shipping_date_clean", ceiling, null_if_still_after)
    fixed = stg.withColumns({"__od": od, "__sd": sd})
    fact = {
        **{c: F.col(c) for c in ("order_item_id", "order_id", "customer_id", "product_card_id")},
        "order_date_key": date_key("__od"), "shipping_date_key": date_key("__sd"),
        "order_date_clean": F.col("__od"), "shipping_date_clean": F.col("__sd"),
        **{dst: F.col(src) for dst, src in _FACT_ATTRS},
        "is_order_date_missing": F.col("__od").isNull(),
        "is_shipping_date_missing": F.col("__sd").isNull(),
        "is_ship_before_order_flag": flag_out_of_order("__od", "__sd"),
        **{c: F.col(c) for c in _CARRIED_FLAGS},
    }
    tied = [TIED] if TIED in stg.columns else []  # goes with its line
    return fixed.select(*[fact[c].alias(c) for c in (fact if columns is None else columns)], *tied)


def calendar_attributes(d) -> dict:
    """Calendar columns of a DATE column (Sunday = 1 ... Saturday = 7)."""
    d = F.col(d) if isinstance(d, str) else d
    dow = F.dayofweek(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "day_of_week": dow,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": dow.isin(1, 7),
        "month_start": F.trunc(d, "MM"),
    }


def build_dim_date(spark: SparkSession, start: dt.date = REFERENCE_CALENDAR[0],
                   end: dt.date = REFERENCE_CALENDAR[1]) -> DataFrame:
    """One row per calendar day in [start, end] with the 10 calendar attributes."""
    spine = date_spine(spark, start, end)
    return spine.select(*[v.alias(k) for k, v in calendar_attributes("full_date").items()])


def calendar_span(fact: DataFrame, col: str = "order_date_clean") -> tuple[dt.date, dt.date]:
    """First day of the first year to last day of the last year of the fact's dates (one aggregated row); without a
    dated row a span that ends before it begins, hence an empty calendar."""
    lo, hi = fact.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return dt.date(1970, 1, 2), dt.date(1970, 1, 1)
    return dt.date(lo.year, 1, 1), dt.date(hi.year, 12, 31)


def _min_per_key(df: DataFrame, key: str, cols: dict) -> DataFrame:
    """``min`` of each column per key. Distinct rows first: that step is a hash aggregate
    on keys only (map-side dedupe), so the string ``min`` (a sort-based aggregate) only
    sees the few distinct combinations per key, never every line."""
    narrow = df.select(key, *[v.alias(k) for k, v in cols.items()]).distinct()
    return narrow.groupBy(key).agg(*[F.min(k).alias(k) for k in cols])


CUSTOMER_SOURCES = ("customer_id", "customer_fname", "customer_lname", "customer_city", "customer_state", "customer_country",
                    "customer_segment_clean", "order_date_clean")
PRODUCT_SOURCES = ("product_card_id", "category_id", "category_name", "department_id", "department_name", "product_name",
                   "product_price", "product_status")


def build_dim_customer(stg: DataFrame) -> DataFrame:
    """One row per customer; descriptive fields take the smallest value (ANY_VALUE made
    reproducible); segment = latest non-null cleaned segment by the staging order date.

    The segment is reduced to (customer, segment, latest date) by a hash aggregate before
    the per-customer pick, which then sees at most one row per segment value."""
    attrs = _min_per_key(stg, "customer_id", {c: F.col(c) for c in (
        "customer_fname", "customer_lname", "customer_city", "customer_state", "customer_country")})
    seg = (stg.filter(F.col("customer_segment_clean").isNotNull())
           .groupBy("customer_id", "customer_segment_clean")
           .agg(F.max("order_date_clean").alias("__d"))
           .groupBy(F.col("customer_id").alias("__cid"))
           .agg(latest_non_null("customer_segment_clean", "__d").alias("customer_segment")))
    j = attrs.join(seg, attrs.customer_id.eqNullSafe(seg.__cid), "left")
    return j.select("customer_id", "customer_fname", "customer_lname", "customer_segment",
                    "customer_city", "customer_state", "customer_country")


def build_dim_product(stg: DataFrame) -> DataFrame:
    """One row per product (ANY_VALUE made reproducible with ``min``); ids typed BIGINT,
    price kept as uncleaned text like the reference."""
    from acct_health.functions.money import safe_int
    return _min_per_key(stg, "product_card_id", {
        "category_id": safe_int("category_id"),
        "category_name": F.col("category_name"),
        "department_id": safe_int("department_id"),
        "department_name": F.col("department_name"),
        "product_name": F.col("product_name"),
        "product_price": F.col("product_price"),
        "product_status": F.col("product_status"),
    })
