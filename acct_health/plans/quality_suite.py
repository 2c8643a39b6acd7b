"""The reference's diagnostics and validations as queries over the driver data.

``raw(spark, sf_dir)`` gives the raw order lines, ``star(spark, sf_dir)`` the written
staging and star tables; each entry maps a query name to ``(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from acct_health.functions.money import safe_int
from acct_health.operators import integrity as I
from acct_health.operators import profile as P
from acct_health.plans.cleaning import MONEY_COLUMNS
from acct_health.plans.star import build_dim_date, calendar_span

UNCLEANED = ("order_status", "shipping_mode", "delivery_status", "late_delivery_risk", "customer_segment", "order_region", "market")
FLAG_COLUMNS = ("real_shipping_days_clean", "scheduled_days_for_shipment_clean", "late_delivery_risk_clean")
DAY_COLUMNS = ("real_shipping_days", "scheduled_days_for_shipment")
ID_COLUMNS = ("customer_id", "order_customer_id", "order_id", "order_item_id", "product_card_id", "order_item_cardprod_id")
AMOUNT_COLUMNS = ("sales", "order_item_total", "order_item_quantity", "order_item_product_price", "order_item_discount",
                  "order_item_discount_rate", "order_profit_per_order", "benefit_per_order", "order_item_profit_ratio",
                  "sales_per_customer")
NULL_CHECK_COLUMNS = ("order_item_total", "order_item_product_price", "order_item_discount",
                      "order_profit_per_order", "benefit_per_order", "sales_per_customer")


def queries(raw, star):
    stg = lambda s, d, *columns: star(s, d).part("stg_orders_final", columns)

    def orphan_dates(s, d):
        f = star(s, d).part("fact_order_item", ("order_date_clean", "order_date_key"))
        cal = build_dim_date(s, *calendar_span(f))
        return I.orphan_count(f, cal, "order_date_key", "date_key", skip_null_keys=True, name="orphaned_date_rows")

    def dim_coverage(s, d):
        _, f, customers, products = star(s, d).parts((), ("customer_id", "product_card_id"), ("dim_customer", "dim_product"))
        return I.dim_coverage(f, {"dim_customer": (customers, "customer_id"), "dim_product": (products, "product_card_id")})

    q = {
        "key_uniqueness_raw": lambda s, d: P.key_uniqueness(raw(s, d), "order_item_id"),
        "key_uniqueness_staging": lambda s, d: P.key_uniqueness(stg(s, d, "order_item_id"), "order_item_id"),
        "duplicate_keys": lambda s, d: P.duplicate_keys(raw(s, d), "order_item_id"),
        "column_mismatch_count": lambda s, d: P.column_mismatch_count(raw(s, d), "customer_id", "order_customer_id"),
        "column_mismatch_count_clean": lambda s, d: P.column_mismatch_count(stg(s, d, "customer_id", "order_customer_id"),
                                                                             "customer_id", "order_customer_id"),
        "duplicate_row_count": lambda s, d: P.duplicate_row_count(raw(s, d)),
        # the type checks A.1.5, B.1.5a and C.1.1, a column list each
        "schema_profile_ids": lambda s, d: P.schema_profile(raw(s, d), ID_COLUMNS),
        "schema_profile": lambda s, d: P.schema_profile(raw(s, d), DAY_COLUMNS),
        "schema_profile_amounts": lambda s, d: P.schema_profile(stg(s, d, *AMOUNT_COLUMNS), AMOUNT_COLUMNS),
        "date_quality_summary": lambda s, d: P.date_quality_summary(stg(s, d, "order_date_clean", "shipping_date_clean", "is_ship_before_order_flag")),
        # the uncleaned text, after deduplication
        **{f"value_counts_{c}_raw": lambda s, d, c=c: P.value_counts(stg(s, d, c), c) for c in UNCLEANED},
        "value_counts_order_country_raw": lambda s, d: P.value_counts(stg(s, d, "order_country"), "order_country", top=60),
        "value_counts_shipping_mode": lambda s, d: P.value_counts(stg(s, d, "shipping_mode_clean"), "shipping_mode_clean"),
        "value_counts_order_status": lambda s, d: P.value_counts(stg(s, d, "order_status_clean"), "order_status_clean"),
        "value_counts_delivery_status": lambda s, d: P.value_counts(stg(s, d, "delivery_status_clean"), "delivery_status_clean"),
        "value_counts_late_risk": lambda s, d: P.value_counts(stg(s, d, "late_delivery_risk_clean"), "late_delivery_risk_clean"),
        "value_counts_segment": lambda s, d: P.value_counts(stg(s, d, "customer_segment_clean"), "customer_segment_clean"),
        "value_counts_region": lambda s, d: P.value_counts(stg(s, d, "order_region_clean"), "order_region_clean"),
        "value_counts_market": lambda s, d: P.value_counts(stg(s, d, "market_clean"), "market_clean"),
        "value_counts_country": lambda s, d: P.value_counts(stg(s, d, "order_country_clean"), "order_country_clean"),
        "quantity_histogram": lambda s, d: P.value_counts(stg(s, d, "order_item_quantity"), safe_int("order_item_quantity"), "qty", by_value=True),
        "day_count_profile": lambda s, d: P.int_range_profile(stg(s, d, *DAY_COLUMNS), DAY_COLUMNS),
        "flag_consistency": lambda s, d: P.flag_consistency(stg(s, d, *FLAG_COLUMNS), *FLAG_COLUMNS),
        "uncastable_sales": lambda s, d: P.uncastable_values(stg(s, d, "sales"), "sales", "double", 30),
        "range_check_discount_rate": lambda s, d: P.range_check(stg(s, d, "order_item_discount_rate"), "order_item_discount_rate", 0.0, 1.0,
                                                                "rate"),
        "range_check_profit_ratio": lambda s, d: P.range_check(stg(s, d, "order_item_profit_ratio"), "order_item_profit_ratio", prefix="ratio"),
        "null_counts_money": lambda s, d: P.null_counts(stg(s, d, *NULL_CHECK_COLUMNS), NULL_CHECK_COLUMNS),
        "cardinality_order_state": lambda s, d: P.cardinality_profile(stg(s, d, "order_state"), "order_state"),
        "parse_failure_counts": lambda s, d: P.parse_failure_counts(
            stg(s, d, *MONEY_COLUMNS, *[f"{c}_clean" for c in MONEY_COLUMNS]), {c: f"{c}_clean" for c in MONEY_COLUMNS}),
        "sales_profile": lambda s, d: P.magnitude_profile(stg(s, d, "sales_clean"), "sales_clean"),
        "quantity_flag_counts": lambda s, d: P.flag_counts(stg(s, d, "is_quantity_missing", "is_quantity_invalid"),
                                                            "is_quantity_missing", "is_quantity_invalid"),
        "row_count_match": lambda s, d: I.row_count_match(*star(s, d).parts(("order_item_id",), ("order_item_id",)), "staging_rows", "fact_rows"),
        "orphan_customers": lambda s, d: I.orphan_count(*star(s, d).parts((), ("customer_id",), ("dim_customer",))[1:], "customer_id",
                                                        name="orphaned_customer_rows"),
        "orphan_products": lambda s, d: I.orphan_count(*star(s, d).parts((), ("product_card_id",), ("dim_product",))[1:], "product_card_id",
                                                       name="orphaned_product_rows"),
        "orphan_dates": orphan_dates,
        "dim_coverage": dim_coverage,
    }
    return q
