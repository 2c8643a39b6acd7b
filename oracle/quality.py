"""Oracle SQL of the data-quality queries."""

from __future__ import annotations

import datetime as dt

from oracle.pipeline import exact_avg, fact_ctes, safe_double, safe_int, sround, staging_ctes, utrim
from oracle.raw import RAW_COLUMNS, raw_order_lines_sql

MONEY = ("sales", "order_item_total", "order_item_product_price", "order_item_discount",
         "order_profit_per_order", "benefit_per_order", "sales_per_customer")


def quality_queries(ceiling: dt.date) -> dict[str, str]:
    R = lambda sel: f"WITH raw AS ({raw_order_lines_sql()})\n{sel}"
    S = lambda sel: f"WITH {staging_ctes()}\n{sel}"
    Fq = lambda sel: f"WITH {fact_ctes(ceiling)}\n{sel}"
    vc = lambda src, col, wrap: wrap(f"SELECT {col}, count(*) AS cnt FROM {src} GROUP BY {col}")
    allc = ", ".join(RAW_COLUMNS)
    days = []
    for c in ("real_shipping_days", "scheduled_days_for_shipment"):
        v = safe_int(c)
        days += [f"min({v}) AS min_{c}", f"max({v}) AS max_{c}", f"count_if({v} < 0) AS negative_{c}",
                 f"count_if({c} IS NOT NULL AND {v} IS NULL) AS unparseable_{c}"]
    bad = []
    for c in MONEY:
        t = utrim(c)
        bad.append(f"count_if({c} IS NOT NULL AND {c}_clean IS NULL AND upper({t}) NOT IN "
                   f"('NONE','N/A','??','-','NULL') AND {t} != '') AS bad_{c}")
    rate, ratio = safe_double("order_item_discount_rate"), safe_double("order_item_profit_ratio")
    return {
        "key_uniqueness_raw": R("SELECT count(*) AS total_rows, count(DISTINCT CAST(order_item_id AS BIGINT)) "
                                "AS distinct_keys FROM raw"),
        "key_uniqueness_staging": S("SELECT count(*) AS total_rows, count(DISTINCT order_item_id) AS distinct_keys FROM stg"),
        "duplicate_keys": R("SELECT order_item_id, count(*) AS cnt FROM raw GROUP BY order_item_id HAVING count(*) > 1"),
        "column_mismatch_count": R("SELECT count_if(customer_id != order_customer_id) AS mismatch_count FROM raw"),
        "column_mismatch_count_clean": S("SELECT count_if(customer_id != order_customer_id) AS mismatch_count FROM stg"),
        "schema_profile": R(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, 'string' AS data_type, count({c}) AS present_rows FROM raw"
            for c in ("real_shipping_days", "scheduled_days_for_shipment"))),
        "schema_profile_ids": R(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, 'string' AS data_type, count({c}) AS present_rows FROM raw"
            for c in ("customer_id", "order_customer_id", "order_id", "order_item_id", "product_card_id", "order_item_cardprod_id"))),
        "schema_profile_amounts": S(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, 'string' AS data_type, count({c}) AS present_rows FROM stg"
            for c in (*MONEY, "order_item_quantity", "order_item_discount_rate", "order_item_profit_ratio"))),
        "duplicate_row_count": R(f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_row_count FROM "
                                 f"(SELECT count(*) AS n FROM raw GROUP BY {allc})"),
        "date_quality_summary": S(f"""SELECT count(*) AS total_rows,
            count_if(order_date_clean IS NULL) AS missing_order_dates,
            count_if(shipping_date_clean IS NULL) AS missing_shipping_dates,
            count_if(is_ship_before_order_flag) AS ship_before_order_cases,
            {sround('count_if(is_ship_before_order_flag) / count(*) * 100', 2)} AS pct_ship_before_order FROM stg"""),
        **{f"value_counts_{c}_raw": vc("stg", c, S) for c in (
            "order_status", "shipping_mode", "delivery_status", "late_delivery_risk", "customer_segment", "order_region", "market")},
        "value_counts_order_country_raw": S("SELECT order_country, count(*) AS cnt FROM stg GROUP BY order_country "
                                            "ORDER BY cnt DESC, order_country ASC NULLS FIRST LIMIT 60"),
        "value_counts_shipping_mode": vc("stg", "shipping_mode_clean", S),
        "value_counts_order_status": vc("stg", "order_status_clean", S),
        "value_counts_delivery_status": vc("stg", "delivery_status_clean", S),
        "value_counts_late_risk": vc("stg", "late_delivery_risk_clean", S),
        "value_counts_segment": vc("stg", "customer_segment_clean", S),
        "value_counts_region": vc("stg", "order_region_clean", S),
        "value_counts_market": vc("stg", "market_clean", S),
        "value_counts_country": vc("stg", "order_country_clean", S),
        "quantity_histogram": S(f"SELECT {safe_int('order_item_quantity')} AS qty, count(*) AS cnt FROM stg GROUP BY 1"),
        "day_count_profile": S(f"SELECT {', '.join(days)} FROM stg"),
        "flag_consistency": S("""SELECT count(*) AS total_comparable_rows,
            count_if((real_shipping_days_clean > scheduled_days_for_shipment_clean AND late_delivery_risk_clean = 1)
              OR (real_shipping_days_clean <= scheduled_days_for_shipment_clean AND late_delivery_risk_clean = 0))
              AS consistent_rows,
            count_if((real_shipping_days_clean > scheduled_days_for_shipment_clean AND late_delivery_risk_clean = 0)
              OR (real_shipping_days_clean <= scheduled_days_for_shipment_clean AND late_delivery_risk_clean = 1))
              AS inconsistent_rows
          FROM stg WHERE real_shipping_days_clean IS NOT NULL AND scheduled_days_for_shipment_clean IS NOT NULL"""),
        "uncastable_sales": S(f"""SELECT DISTINCT sales AS raw_value FROM stg
          WHERE {safe_double('sales')} IS NULL AND sales IS NOT NULL ORDER BY raw_value LIMIT 30"""),
        "range_check_discount_rate": S(f"""SELECT min({rate}) AS min_rate, max({rate}) AS max_rate,
            count_if({rate} < 0 OR {rate} > 1) AS out_of_range_count,
            count_if(order_item_discount_rate IS NULL) AS null_count FROM stg"""),
        "range_check_profit_ratio": S(f"""SELECT min({ratio}) AS min_ratio, max({ratio}) AS max_ratio,
            count_if(order_item_profit_ratio IS NULL) AS null_count FROM stg"""),
        "null_counts_money": S("SELECT " + ", ".join(
            f"count_if({c} IS NULL) AS null_{c}" for c in MONEY[1:]) + " FROM stg"),
        "cardinality_order_state": S("SELECT count(DISTINCT order_state) AS distinct_values, "
                                     "count_if(order_state IS NULL) AS null_values FROM stg"),
        "parse_failure_counts": S(f"SELECT {', '.join(bad)} FROM stg"),
        "sales_profile": S("SELECT min(sales_clean) AS min_sales_clean, max(sales_clean) AS max_sales_clean, "
                           f"{exact_avg('sales_clean')} AS avg_sales_clean FROM stg WHERE sales_clean IS NOT NULL"),
        "quantity_flag_counts": S("SELECT count_if(is_quantity_missing) AS missing_count, "
                                  "count_if(is_quantity_invalid AND NOT is_quantity_missing) AS invalid_count, "
                                  "count(*) AS total_rows FROM stg"),
        "row_count_match": Fq("SELECT (SELECT count(*) FROM stg) AS staging_rows, (SELECT count(*) FROM fact) AS fact_rows"),
        "orphan_customers": Fq("SELECT count(*) AS orphaned_customer_rows FROM fact f LEFT JOIN dim_customer c "
                               "ON f.customer_id = c.customer_id WHERE c.customer_id IS NULL"),
        "orphan_products": Fq("SELECT count(*) AS orphaned_product_rows FROM fact f LEFT JOIN dim_product p "
                              "ON f.product_card_id = p.product_card_id WHERE p.product_card_id IS NULL"),
        "orphan_dates": Fq("""SELECT count(*) AS orphaned_date_rows FROM fact f LEFT JOIN (
              SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key FROM (SELECT CAST(unnest(generate_series(
                CAST(date_trunc('year', (SELECT min(order_date_clean) FROM fact)) AS DATE),
                CAST(date_trunc('year', (SELECT max(order_date_clean) FROM fact)) AS DATE) + INTERVAL 1 YEAR
                  - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d)) dd
            ON f.order_date_key = dd.date_key WHERE f.order_date_key IS NOT NULL AND dd.date_key IS NULL"""),
        "dim_coverage": Fq("""SELECT (SELECT count(*) FROM dim_customer) AS dim_customer_rows,
            (SELECT count(DISTINCT customer_id) FROM fact) AS distinct_customer_ids_in_fact,
            (SELECT count(*) FROM dim_product) AS dim_product_rows,
            (SELECT count(DISTINCT product_card_id) FROM fact) AS distinct_product_card_ids_in_fact"""),
    }
